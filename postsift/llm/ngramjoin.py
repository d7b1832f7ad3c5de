"""Exact n-gram Jaccard join by blocked sparse products of the document by n-gram incidence matrix.

Texts with the same set of shingles are one class; their links need no comparison. Classes are rows of the matrix, shingles columns.

1. Columns are dealt into blocks by hash; those that very many rows have ("hot": found by frequent-items counts of each task, added up) are
   known to be shared, need no counting, and are dealt into blocks by row. A block sees which rows each of its columns has and drops columns with a single row:
   they add to a row's size, never to an overlap. What is left of each row comes back with how many rows the column has.
2. A row whose remaining columns are fewer than the share of its size that any partner would have to match has no partner, and goes.
   In common corpora that is all but the near copies.
3. By the rarest-first order of columns, two rows can only be similar enough if they share a column among the first
   ``size - least overlap + 1`` of both. Rows that share such a column are put into a group named after the smallest row there
   (and then after that row's own smallest), so that near copies meet in one or two groups.
4. A group is cut into tiles of about ``TILE`` rows or ``ENTRIES`` columns in all, whichever is less. Each pair of tiles is one task: it accumulates the overlaps by blocks of columns,
   as matrix products for columns with many rows, pair by pair for the others, and discards pairs under the bound that
   their sizes set. What comes back is a spanning forest of the links that were found, never all pairs.
5. Components of these links give the component of each class, and so of each document.

The result is exact up to collisions: shingles are 64-bit hashes, columns 32 bits within a block of about ``BLOCK`` entries, classes 64
bits of a 128-bit hash of the set. Copies are dropped before anything is shuffled by block, per partition and then per block. All
intermediate tables are written to the shared folder. No group exceeds a block, the entries of one column that is not hot, or two tiles. What reaches
the driver are the hot columns: those with over a ``HOT_COLUMNS``-th of all entries each, so never more than ``HOT_COLUMNS``. Which columns are taken for hot
changes how entries are grouped and how tightly rows are pruned, never the result.

Defined results: null or empty text, or one without words, has no shingles and links with nothing. A text of fewer words than
a shingle has its whole sequence as its only shingle. Rows that repeat an id are texts of their own and share the id. A null id never
names a component unless all its ids are null. An empty table gives an empty table. Other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm import pretokens as pt
from postsift.llm import shingles
from postsift.llm.bpe import lengths
from postsift.llm.common import Scratch
from postsift.llm.components import connected

#: Bytes of text and matrix entries handled at a time; rows of a tile; columns of a dense product; rows up to which a column is handled by pairs.
SLICE, BLOCK, TILE, DENSE, FEW = 500_000, 4_000_000, 512, 4096, 12
#: Columns of the rows of a tile, all counted.
ENTRIES = 400_000
#: Classes whose copies a task remembers, so as to send each only once.
REMEMBERED = 200_000
#: Rows from which a column may be hot; columns that may be hot; columns that a task counts, and sends.
HOT, HOT_COLUMNS, COUNTED = 250_000, 500_000, 8192
#: Order of hot columns: after all others.
LAST = 255


def class_of(own: np.ndarray) -> int:
    """A signed 64-bit name for a set."""
    return int.from_bytes(xxhash.xxh3_128_digest(own.tobytes())[:8], "little", signed=True)


def slices_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of batches whose column ``text`` is binary or string, with the set of each text."""
    for whole in batches:
        at = whole.schema.get_field_index("text")
        for begin, end in pt.slices(lengths(whole.column(at)).tolist(), SLICE):
            b = whole.slice(begin, end - begin)
            yield b, shingles.sets([t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()], width)


class Frequent:
    """The columns that most of the sets seen have, with counts that are too small by no more than a ``COUNTED``-th of all
    counted, and by the entries that were alone in their slice."""

    def __init__(self):
        self.columns, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, sets: list[np.ndarray]) -> None:
        columns, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts > 1
        columns = np.concatenate((self.columns, columns[often]))
        self.columns, inverse = np.unique(columns, return_inverse=True)
        self.counts = np.bincount(inverse, np.concatenate((self.counts, counts[often])), len(self.columns)).astype(np.int64)
        if len(self.columns) > COUNTED:  # what the first column that does not fit has, all lose
            left = self.counts - np.partition(self.counts, -COUNTED - 1)[-COUNTED - 1]
            self.columns, self.counts = self.columns[left > 0], left[left > 0]


def measured(docs: DataFrame, width: int) -> DataFrame:
    """doc, n, class, hot: the size and name of each text's set; class null for empty sets.

    Rows with ``hot`` are no documents but columns that many sets of a task have: n of them, copies left out.
    """
    schema = "doc long, n long, class long, hot long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, often = set(), Frequent()
        for b, found in slices_of(batches, width):
            names = [class_of(s) if len(s) else None for s in found]
            own = unsent(found, names, sent)
            if own:
                often.add(list(own.values()))
            sizes = pa.array([len(s) for s in found], pa.int64())
            columns = [b.column(0), sizes, pa.array(names, pa.int64()), pa.nulls(len(names), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "n", "class", "hot"])
        none = pa.nulls(len(often.counts), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(often.counts), none, pa.array(often.columns.view(np.int64))], names=["doc", "n", "class", "hot"])

    return docs.mapInArrow(run, schema)


def unsent(found: list[np.ndarray], names: list[int | None], sent: set[int]) -> dict[int, np.ndarray]:
    """The sets that are not empty and that the task has not had before, as far as it remembers."""
    if len(sent) > REMEMBERED:
        sent.clear()
    own = {name: s for s, name in zip(found, names) if name is not None and name not in sent}
    sent.update(own)
    return own


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks are ranges of the upper halves of the hashes."""
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def incidence(docs: DataFrame, width: int, blocks: int, hot: np.ndarray, parts: int) -> DataFrame:
    """block, rows, counts, columns: for each block some rows with their columns, packed as arrays.

    The columns in ``hot`` (sorted) go to blocks from ``blocks`` on, one of ``parts`` by row, under their places in ``hot``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for _, found in slices_of(batches, width):
            own = unsent(found, [class_of(s) if len(s) else None for s in found], sent)
            if not own:
                continue
            rows = np.fromiter(own, np.int64, len(own))
            sizes = np.fromiter(map(len, own.values()), np.int64, len(own))
            entries = np.concatenate(list(own.values()))
            block, row, low = block_of(entries, blocks), np.repeat(np.arange(len(rows)), sizes), entries.astype(np.uint32)
            if len(hot):
                place = np.minimum(np.searchsorted(hot, entries), len(hot) - 1)
                is_hot = hot[place] == entries
                block = np.where(is_hot, (blocks + bucket_of(rows, parts))[row], block)
                low = np.where(is_hot, place, low).astype(np.uint32)
            # By block, then by row.
            order = np.argsort(block, kind="stable")
            block, row, low = block[order], row[order], np.ascontiguousarray(low[order])
            present, borders = np.unique(block, return_index=True)
            out: list[tuple] = []
            for k, begin, end in zip(present.tolist(), borders.tolist(), [*borders[1:].tolist(), len(block)]):
                part = slice(begin, end)
                first = np.flatnonzero(np.diff(row[part], prepend=-1))
                which, counts = row[part][first], np.diff(first, append=end - begin)
                out.append((k, rows[which].tobytes(), small(counts), low[part].tobytes()))
            columns = [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*out))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "rows", "counts", "columns"])

    return docs.mapInArrow(run, "block int, rows binary, counts binary, columns binary")


def small(counts: np.ndarray) -> bytes:
    """Counts of entries, in two bytes each if they fit."""
    return counts.astype(np.uint16 if counts.max() < 1 << 16 else np.uint32).tobytes()


def joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def joined_counts(table: pa.Table) -> np.ndarray:
    """One count for each row, whose name takes eight bytes."""
    both = zip(table["counts"].to_pylist(), table["rows"].to_pylist())
    return np.concatenate([np.frombuffer(c, np.uint16 if len(c) * 4 == len(r) else np.uint32) for c, r in both]).astype(np.int32)


def spread_out(counts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Positions of the entries of the chosen rows, given the number of entries of each row."""
    begin = np.cumsum(counts) - counts
    n = counts[chosen]
    ahead = np.cumsum(n) - n
    return np.arange(int(n.sum())) + np.repeat(begin[chosen] - ahead, n)


def shared_columns(table: pa.Table, buckets: int) -> pa.Table:
    """Of one block, the entries in columns that several rows have, packed by bucket of rows.

    ``ranks``: a byte that grows with the number of rows of the column, to order columns by. A block from ``buckets`` on is a part of the hot
    columns, of which all entries stay; they share one name.
    """
    block = table["block"][0].as_py()
    is_hot, block = block >= buckets, min(block, buckets)
    rows, counts, columns = joined(table, "rows", np.int64), joined_counts(table), joined(table, "columns", np.uint32)
    rows, once = np.unique(rows, return_index=True)
    columns, counts = columns[spread_out(counts, once)], counts[once]  # each copy once
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), counts)
    order = np.argsort(columns, kind="stable")
    sorted_ = columns[order]
    begins = np.append(True, sorted_[1:] != sorted_[:-1])[: len(sorted_)]
    first = np.flatnonzero(begins)
    has = np.diff(first, append=len(order))
    times = np.repeat(has.astype(np.int32), has)
    shared = times > (0 if is_hot else 1)
    kept, times = order[shared], times[shared]
    back = np.argsort(kept, kind="stable")  # by row again
    kept, times = kept[back], times[back]
    columns, owner = columns[kept], owner[kept]
    ranks = np.minimum(LAST, 8 * np.log2(np.maximum(times, 1))).astype(np.uint8)
    if is_hot:
        ranks[:] = LAST  # parts know their own rows only, and the order of columns must be one for all rows
    counts = np.bincount(owner, minlength=len(rows))
    bucket = np.where(counts > 0, bucket_of(rows, buckets), -1)
    out: dict[str, list] = {c: [] for c in ("bucket", "block", "rows", "counts", "columns", "ranks")}
    by_bucket = np.argsort(bucket, kind="stable")
    present, borders = np.unique(bucket[by_bucket], return_index=True)
    for k, chosen in zip(present.tolist(), np.split(by_bucket, borders[1:])):
        if k < 0:
            continue
        entries = spread_out(counts, chosen)
        out["bucket"].append(k)
        out["block"].append(block)
        out["rows"].append(rows[chosen].tobytes())
        out["counts"].append(small(counts[chosen]))
        out["columns"].append(columns[entries].tobytes())
        out["ranks"].append(ranks[entries].tobytes())
    return pa.table({c: pa.array(v, pa.int32() if c in ("bucket", "block") else pa.binary()) for c, v in out.items()})


def bucket_of(rows: np.ndarray, buckets: int) -> np.ndarray:
    return (shingles.mixed(rows.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def with_bucket(sizes: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("bucket", pa.array(bucket_of(b.column(0).to_numpy(), buckets)))

    return sizes.mapInArrow(run, "class long, n long, bucket int")


SHARED = "bucket int, block int, rows binary, counts binary, columns binary, ranks binary"


def eligible_rows(table: pa.Table, known: pa.Table, percent: int) -> pa.Table:
    """Rows that could have a partner: their shared columns, and how many of the rarest ones every partner shares at least one of.

    ``known``: class, n: the sizes of the rows of the bucket.
    """
    if not table.num_rows:
        return pa.table({"row": pa.array([], pa.int64()), "size": pa.array([], pa.int64()), "head": pa.array([], pa.int64()), "columns": pa.array([], pa.list_(pa.int64()))})
    rows, counts = joined(table, "rows", np.int64), joined_counts(table)
    blocks = np.repeat(table["block"].to_numpy(), [len(x) // 8 for x in table["rows"].to_pylist()]).astype(np.int64)
    names, number = np.unique(rows, return_inverse=True)
    total = np.bincount(number, counts, len(names)).astype(np.int64)
    order = np.argsort(known["class"].to_numpy())
    size = known["n"].to_numpy()[order][np.searchsorted(known["class"].to_numpy()[order], names)]
    good = 100 * total >= percent * size
    owner = np.repeat(number.astype(np.int32), counts)
    kept = good[owner]
    owner = owner[kept]
    columns = np.repeat(blocks, counts)[kept] << 32 | joined(table, "columns", np.uint32)[kept].astype(np.int64)
    order = np.lexsort((columns, joined(table, "ranks", np.uint8)[kept], owner))
    n = total[good]
    least = -(-percent * size[good] // 100)
    head = np.maximum(0, size[good] - least + 1 - (size[good] - n))
    offsets = pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32())
    return pa.table(
        {
            "row": pa.array(names[good]),
            "size": pa.array(size[good]),
            "head": pa.array(head),
            "columns": pa.ListArray.from_arrays(offsets, pa.array(columns[order])),
        }
    )


def overlaps(sets: list[np.ndarray], tile: np.ndarray | None) -> np.ndarray:
    """How many columns each two rows share; only rows of different tiles count if tiles are given.

    Columns that a pair of tiles does not share are dropped; the others are accumulated block by block.
    """
    n = len(sets)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.diff(flat, prepend=flat[0] - 1)) if len(flat) else np.zeros(0, np.int64)
    has = np.diff(first, append=len(flat))
    total = np.zeros((n, n), np.float32)
    for d in range(2, FEW + 1):  # columns of d rows: all their pairs at once
        at = first[has == d]
        for part in range(0, len(at), 1 << 16):
            rows = owner[at[part : part + (1 << 16), None] + np.arange(d)]
            for i in range(d):
                for j in range(i + 1, d):
                    pairs = np.bincount(rows[:, i] * n + rows[:, j], minlength=n * n) if n * n < 4 * len(rows) else None
                    if pairs is not None:
                        total += pairs.reshape(n, n)
                    else:
                        np.add.at(total, (rows[:, i], rows[:, j]), 1)
    total += total.T
    many = np.flatnonzero(has > FEW)
    for part in range(0, len(many), DENSE):
        chosen = many[part : part + DENSE]
        matrix = np.zeros((n, len(chosen)), np.float32)
        matrix[owner[spread_out(has, chosen)], np.repeat(np.arange(len(chosen)), has[chosen])] = 1
        total += matrix @ matrix.T
    if tile is not None:
        total[tile[:, None] == tile[None, :]] = 0
    np.fill_diagonal(total, 0)
    return total


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row the first row that it is connected with."""
    root = np.arange(len(linked))
    a, b = np.nonzero(linked)
    while True:
        new = root.copy()
        np.minimum.at(new, root[a], root[b])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tile_links(table: pa.Table, percent: int) -> pa.Table:
    """A spanning forest of the links between two tiles, or within one."""
    rows = table["row"].to_numpy()
    size = table["size"].to_numpy()
    sets = [np.asarray(x) for x in np.split(table["columns"].combine_chunks().flatten().to_numpy(), np.cumsum(lengths(table["columns"].combine_chunks()))[:-1])]
    within = table["i"][0].as_py() == table["j"][0].as_py()
    total = overlaps(sets, None if within else table["tile"].to_numpy())
    union = size[:, None] + size[None, :] - total
    root = forest((total > 0) & (100 * total >= percent * union))
    joined_ = np.flatnonzero(root != np.arange(len(rows)))
    return pa.table({"a": pa.array(rows[joined_]), "b": pa.array(rows[root[joined_]])})


def jaccard_join(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75) -> DataFrame:
    """doc, n_shingles, component_id for each row: the size of its set and the smallest id reachable by links.

    Two rows link when ``100 * intersection >= percent * union`` of their sets of ``width``-word shingles.
    """
    scratch = Scratch(df.sparkSession, "ngrams")
    docs = df.select(F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    both = scratch.written(measured(docs, width), "documents", waves=8)
    info = both.where("hot is null").drop("hot")
    entries = info.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(entries / BLOCK))
    often = both.where("hot is not null").groupBy("hot").agg(F.sum("n").alias("n")).where(F.col("n") > max(HOT, entries // HOT_COLUMNS))
    hot, times = [np.array(x.to_numpy(), np.int64) for x in often.toArrow().select(["hot", "n"]).columns]
    hot = np.sort(hot.view(np.uint64))

    parts = incidence(docs.select("text"), width, blocks, hot, max(1, math.ceil(int(times.sum()) / BLOCK))).groupBy("block")
    shared = parts.applyInArrow(lambda t: shared_columns(t, blocks), SHARED)
    # Sizes follow the rows to their buckets, once each; a bucket is a hash of the row's name, as in `shared_columns`.
    sizes = info.where("class is not null").groupBy("class").agg(F.first("n").alias("n"))
    sizes = with_bucket(sizes, blocks).groupBy("bucket")
    found = shared.groupBy("bucket").cogroup(sizes)
    rows = found.applyInArrow(lambda t, known: eligible_rows(t, known, percent), "row long, size long, head long, columns array<long>")
    rows = scratch.written(rows, "rows", waves=2)

    # Columns among the rarest of several rows; rows meet in groups named after the smallest row of such a column.
    heads = scratch.written(rows.select("row", F.explode(F.slice("columns", F.lit(1), F.col("head").cast("int"))).alias("column")).distinct(), "heads", waves=2)
    named = heads.groupBy("column").agg(F.min("row").alias("group"), F.count("*").alias("n")).where("n > 1").drop("n")
    member = scratch.written(heads.join(named, "column").select("row", "group").distinct(), "members-0", waves=2)
    for step in (1, 2):
        smallest = member.groupBy("row").agg(F.min("group").alias("next")).withColumnRenamed("row", "group")
        member = member.join(smallest, "group").select("row", F.col("next").alias("group")).distinct()
        member = scratch.written(member, f"members-{step}", waves=2)

    weighed = member.join(rows.select("row", F.size("columns").alias("entries")), "row").groupBy("group")
    tiles = weighed.agg(F.ceil(F.greatest(F.count("*") / TILE, F.sum("entries") / ENTRIES)).cast("int").alias("tiles"), F.count("*").alias("n"))
    tiles = tiles.where("n > 1").drop("n")
    tiled = member.join(tiles, "group").withColumn("tile", F.pmod(F.xxhash64("row"), F.col("tiles")).cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("row", "group", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    pairs = tiled.join(rows.drop("head"), "row").groupBy("group", "i", "j")
    links = pairs.applyInArrow(lambda t: tile_links(t, percent), "a long, b long")
    roots = connected(scratch.written(links, "links", waves=2), scratch)

    classes = info.where("class is not null").groupBy("class").agg(F.min("doc").alias("least"))
    classes = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = scratch.written(classes.select("class", "root").join(least, "root").select("class", "component_id"), "classes", waves=2)
    done = info.join(classes, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc")).otherwise(F.col("component_id"))
    return done.select("doc", F.col("n").alias("n_shingles"), own.alias("component_id"))
