"""Exact removal of repeated byte strings: bucket-pointer refinement over sampled suffixes.

A suffix is a place in a text. It is repeated if its first ``window`` bytes also start anywhere else. Bucket identifiers are 64-bit mixes:
two suffixes are in the same bucket of depth h if their first h bytes are the same.

1. **Initial buckets.** The bucket of depth 8 is the 8-gram itself. The bucket of depth 2h at p is the pair of the buckets of depth h at p and at
   the later offset p + h; each level reuses what the level before updated. This needs only a text's own bytes.
2. **Which suffixes travel.** Within the window at p, the 32-gram with the least identifier is its anchor; equal windows have it at the same
   offset. Neighbouring suffixes with one anchor form a run, which is one row: the anchor's bucket, and the bucket of all bytes of the run. A run is
   about 140 bytes long, so there are far fewer rows than suffixes.
3. **First refinement.** Rows are dealt by the anchor's bucket and sorted on the bucket of the run. Alone in its anchor's bucket: no suffix
   of the run is repeated, it leaves. Another run has the same bytes: all its suffixes are repeated, it leaves. The rest goes on.
4. **Second refinement.** What goes on is cut into pieces of at most ``Sizes.cell`` suffixes, at fixed offsets from the anchor, dealt by the bucket of
   the bytes that all suffixes of such a piece have in common, sorted on the bucket of all its bytes, and leaves in the same two ways.
5. **Last refinement.** In what is left, each suffix has its bucket of full depth from the common bytes and the few bytes before and after them.
6. Each text loses the union of the windows of its repeated suffixes.

Texts with the same bytes are one class; a class of two or more rows is repeated as a whole, and one row of it stands for it as a partner.
Texts travel twice, compressed: to the second refinement, and to have their bytes cut out. Sorted rows are read as a stream, so a bucket
can have any number of rows: repeats within a slice of texts leave before the shuffle, and a bucket of more than ``Sizes.open`` different pieces
is counted by suffix in a shuffle of its own. Long texts are worked through in parts of ``Sizes.part`` suffixes. All tables between steps are written to
the shared folder.

The result is exact up to collisions of 64-bit identifiers. Defined results: null text is empty; texts shorter than the window lose nothing.
Rows that repeat an id are texts of their own, and return a row each; a null id is kept. What is left need not be valid UTF-8, so it is
binary. An empty table gives an empty table. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm import pretokens as pt
from postsift.llm.common import Scratch
from postsift.llm.shingles import mixed

#: Bytes of the first buckets, and of anchors if the window is long enough.
FIRST, ANCHOR = 8, 32


@dataclass(frozen=True)
class Sizes:
    """How much is handled at a time; the result is the same for all values."""

    cell: int = 32  # suffixes of a piece of the second refinement
    slice: int = 1_000_000  # bytes of text
    part: int = 1 << 17  # suffixes of a part of a long text
    step: int = 1 << 17  # suffixes whose buckets are worked out at a time
    open: int = 16_384  # rows of one bucket
    remembered: int = 200_000  # contents, and classes, that a task remembers

    def cell_of(self, window: int) -> int:
        """The bytes that the suffixes of a piece have in common must not be fewer than those of a first bucket."""
        return max(1, min(self.cell, window - FIRST + 1))


K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
#: What a row says: to be decided; repeated, and there as a partner; repeated, decided before the shuffle; one suffix of a crowded bucket.
OPEN_RUN, PARTNER, REPEATED, SUFFIX = range(4)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(a * K1 + b * K2)


class Buckets:
    """Buckets of the suffixes of some bytes, for depths that are ``FIRST`` times a power of two, up to ``deepest``. With ``depths``, only the
    levels that these need are kept."""

    def __init__(self, data: bytes, deepest: int, *depths: int):
        n = len(data)
        first = np.zeros(max(0, n - FIRST + 1), np.uint64)
        for k in range(min(FIRST, len(first))):
            of_phase = first[k::FIRST]
            of_phase[:] = np.frombuffer(data, np.uint64, len(of_phase), k)
        self.at = {FIRST: mixed(first + K3)}
        depth = FIRST
        while 2 * depth <= deepest:
            before = self.at[depth]
            self.at[2 * depth] = pair(before[:-depth], before[depth:])
            if depths and not any(depth <= d < 2 * depth for d in depths):
                del self.at[depth]
            depth *= 2

    def of(self, places: np.ndarray, depth: int) -> np.ndarray:
        """Buckets of any depth: a shorter one's, and its at the later offset where the rest ends."""
        half = max(d for d in self.at if d <= depth)
        return pair(self.at[half][places], self.at[half][places + (depth - half)])


def least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    begun = np.minimum.accumulate(blocks, axis=1).ravel()
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], begun[width - 1 : width - 1 + n])


def anchor_size(window: int) -> int:
    """Bytes of an anchor: a bucket's depth of at most ``ANCHOR`` and half of the window."""
    size = FIRST
    while 2 * size <= min(ANCHOR, window // 2):
        size *= 2
    return size


def runs(parts: list[bytes], window: int, cell: int, step: int) -> dict[str, np.ndarray]:
    """All runs of suffixes of some parts of texts: ``part``, ``lo`` and ``n`` (first suffix and how many), ``bucket``, ``whole``.

    ``bucket``: of the anchor; with ``cell``, of the bytes common to the suffixes of a cell, which begin at ``core``. ``whole``: of all bytes of the run.
    Parts are worked through about ``step`` bytes at a time, as a byte takes some hundred bytes of arrays and a run only a row.
    """
    some = []
    for begin, end in pt.slices(list(map(len, parts)), step):
        r = runs_at_once(parts[begin:end], window, cell)
        some.append(r | {"part": r["part"] + begin})
    return {c: np.concatenate([r[c] for r in some]) for c in some[0]}


def runs_at_once(parts: list[bytes], window: int, cell: int) -> dict[str, np.ndarray]:
    data = b"".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    first = np.cumsum(sizes) - sizes
    size = anchor_size(window)
    common = window - cell + 1  # bytes that all suffixes of a cell have in common
    b = Buckets(data, window, size, window, *[common] * bool(cell))
    # The least identifier of the anchors in a window, then the first place of it; places are in the lower half.
    places = np.arange(len(b.at[size]), dtype=np.uint64)
    anchor = least_ahead(b.at[size] & np.uint64(0xFFFFFFFF00000000) | places, window - size + 1) & np.uint64(0xFFFFFFFF)
    count = np.maximum(0, sizes - window + 1)
    part = np.repeat(np.arange(len(parts)), count)
    p = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    anchor = anchor[p].astype(np.int64)
    step = (anchor - p) // cell if cell else np.zeros(len(p), np.int64)
    begins = np.append(True, (np.diff(p) != 1) | (np.diff(anchor) != 0) | (np.diff(step) != 0))[: len(p)]
    at = np.flatnonzero(begins)
    n = np.diff(at, append=len(p))
    lo, anchor = p[at], anchor[at]
    whole = pair(pair(b.of(lo, window), b.of(lo + n - 1, window)), n.astype(np.uint64))
    out = {"part": part[at], "lo": lo - first[part[at]], "n": n, "whole": whole}
    if not cell:
        return out | {"bucket": b.of(anchor, size)}
    core = anchor - cell * step[at]
    return out | {"bucket": b.of(core, common), "core": core - first[part[at]]}


def parts_of(batches: Iterator[pa.RecordBatch], window: int, z: Sizes) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Slices of texts (class, text): parts, and each one's class and where it begins. A class comes once, as long as it is remembered."""
    seen: set[int] = set()
    parts: list[bytes] = []
    of: list[tuple[int, int]] = []
    total = 0
    for b in batches:
        for name, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            if len(text) < window or name in seen:
                continue
            if len(seen) >= z.remembered:
                seen.clear()
            seen.add(name)
            for begin in range(0, len(text) - window + 1, z.part):
                parts.append(text[begin : begin + z.part + window - 1])
                of.append((name, begin))
                total += len(parts[-1])
                if total >= z.slice:
                    yield parts, *np.array(of).T
                    parts, of, total = [], [], 0
    if parts:
        yield parts, *np.array(of).T


ROWS = "bucket long, whole long, class long, lo long, n int, said byte"


def batch_of(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Arrays as a batch; identifiers become signed."""
    kinds = {"n": np.int32, "said": np.int8}
    signed = {c: (v.view(np.int64) if v.dtype == np.uint64 else v.astype(kinds.get(c, np.int64), copy=False)) for c, v in columns.items()}
    return pa.RecordBatch.from_arrays([pa.array(v) for v in signed.values()], names=list(signed))


def first_rows(texts: DataFrame, window: int, z: Sizes) -> DataFrame:
    """Rows of runs. Runs that are repeated within a slice are decided here, but one of them travels as a partner."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, np.uint64)  # contents of which two are on their way
        for parts, names, begins in parts_of(batches, window, z):
            r = runs(parts, window, 0, z.step)
            order = np.argsort(r["whole"], kind="stable")
            r = {c: v[order] for c, v in r.items()}
            first = np.append(True, np.diff(r["whole"]) != 0)
            at = np.flatnonzero(first)
            often = np.diff(at, append=len(first)) > 1
            said = np.full(len(first), REPEATED)
            said[at] = np.where(often, PARTNER, OPEN_RUN)
            said[np.isin(r["whole"], known)] = REPEATED
            known = np.union1d(known, r["whole"][at[often]]) if len(known) < z.remembered else r["whole"][at[often]]
            class_ = names[r["part"]]
            bucket = np.where(said == REPEATED, class_.view(np.uint64), r["bucket"])  # decided rows go anywhere
            yield batch_of({"bucket": bucket, "whole": r["whole"], "class": class_, "lo": r["lo"] + begins[r["part"]], "n": r["n"], "said": said})

    return texts.mapInArrow(run, ROWS)


def second_rows(asked: DataFrame, window: int, z: Sizes) -> DataFrame:
    """The pieces of runs that were asked for (class, packed text, their lo, n and said), with the bytes around their common ones."""
    cell = z.cell_of(window)

    def pieces(parts: list[bytes], of: list[tuple[int, int, int]]) -> pa.RecordBatch:
        r = runs(parts, window, cell, z.step)
        class_, begin, said = (np.array(x, np.int64)[r["part"]] for x in zip(*of))
        said = np.where(said == PARTNER, PARTNER, OPEN_RUN)
        rows = batch_of({"bucket": r["bucket"], "whole": r["whole"], "class": class_, "lo": r["lo"] + begin, "n": r["n"], "said": said})
        around = []
        for k, core, lo, n in zip(r["part"].tolist(), r["core"].tolist(), r["lo"].tolist(), r["n"].tolist()):
            around.append(parts[k][lo:core] + parts[k][core + window - cell + 1 : lo + n - 1 + window])
        return rows.append_column("ahead", pa.array(r["core"] - r["lo"], pa.int32())).append_column("around", pa.array(around, pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        parts: list[bytes] = []
        of: list[tuple[int, int, int]] = []
        total = 0
        for b in batches:
            for i in range(b.num_rows):
                name, packed, spans = (b.column(k)[i].as_py() for k in range(3))
                text = unpack.decompress(packed)
                for s in spans:
                    parts.append(text[s["lo"] : s["lo"] + s["n"] + window - 1])
                    of.append((name, s["lo"], s["said"]))
                    total += len(parts[-1])
                    if total >= z.slice:
                        yield pieces(parts, of)
                        parts, of, total = [], [], 0
        if parts:
            yield pieces(parts, of)

    return asked.mapInArrow(run, ROWS + ", ahead int, around binary")


def copies(t: pa.Table) -> np.ndarray:
    """Rows that repeat the class and place of the row before, in the same bucket."""
    same = np.ones(max(0, t.num_rows - 1), bool)
    for c in ("bucket", "class", "lo"):
        same &= np.diff(t[c].to_numpy()) == 0
    return np.append(False, same)[: t.num_rows]


def buckets_in(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Table, bool]]:
    """Sorted rows as tables of whole buckets; a bucket of more than ``limit`` rows comes as several tables of its own, with a mark.

    Rows with one content come together as long as they fit; of more, two go on to the next table.
    """
    held: pa.Table | None = None
    large = None  # the bucket of which a part was given before
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        held = held.filter(pa.array(~copies(held))).combine_chunks()
        bucket = held["bucket"].to_numpy()
        cut = last_of(bucket)
        if cut:
            mine = int(np.searchsorted(bucket, large, side="right")) if large is not None and bucket[0] == large else 0
            if mine:
                yield held.slice(0, mine), True
            if cut > mine:
                yield held.slice(mine, cut - mine), False
        elif held.num_rows > limit:
            cut = last_of(held["whole"].to_numpy()) or held.num_rows - 2
            yield held.slice(0, cut), True
            large = bucket[-1]
        held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held, large is not None and held["bucket"][0].as_py() == large


def last_of(values: np.ndarray) -> int:
    """Where the last run of equal values begins."""
    other = np.flatnonzero(values != values[-1])
    return int(other[-1]) + 1 if len(other) else 0


def judged(t: pa.Table, large: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are repeated, which are undecided, which are the first of a content, and which are in a bucket with undecided ones."""
    bucket, whole = t["bucket"].to_numpy(), t["whole"].to_numpy()
    number = np.cumsum(np.append(True, np.diff(bucket) != 0)) - 1
    first = np.append(True, (np.diff(bucket) != 0) | (np.diff(whole) != 0))
    content = np.cumsum(first) - 1
    often = (np.bincount(content) > 1) | (np.bincount(content, t["said"].to_numpy() != OPEN_RUN) > 0)
    repeated = often[content]
    undecided = ~repeated & ((np.bincount(number, first)[number] > 1) | large)
    return repeated, undecided, first, np.bincount(number, undecided)[number] > 0


FOUND = "class long, lo long, n int, said byte, suffix long"


def spans_of(t: pa.Table, chosen: np.ndarray, said: int) -> pa.RecordBatch:
    part = t.filter(pa.array(chosen))
    columns = [part[c].combine_chunks() for c in ("class", "lo", "n")]
    columns += [pa.array(np.full(part.num_rows, said, np.int8)), pa.nulls(part.num_rows, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["class", "lo", "n", "said", "suffix"])


def first_refined(z: Sizes):
    """Repeated runs, undecided ones, and one partner for each content of a bucket that has undecided ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, large in buckets_in(batches, z.open):
            decided = t["said"].to_numpy() == REPEATED
            yield spans_of(t, decided, REPEATED)
            t = t.filter(pa.array(~decided))
            if t.num_rows:
                repeated, undecided, first, open_ = judged(t, large)
                yield spans_of(t, repeated, REPEATED)
                yield spans_of(t, undecided, OPEN_RUN)
                yield spans_of(t, repeated & first & (open_ | large), PARTNER)

    return run


def suffix_buckets(t: pa.Table, cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the row and bucket of full depth of each suffix of some pieces."""
    ahead, n = t["ahead"].to_numpy().astype(np.int64), t["n"].to_numpy().astype(np.int64)
    around = t["around"].to_pylist()
    flat = np.append(np.frombuffer(b"".join(around), np.uint8), np.uint8(0)).astype(np.uint64)
    size = np.fromiter(map(len, around), np.int64, len(around))
    begin = np.cumsum(size) - size
    # Buckets of the k bytes before, and after, the common ones; places beyond a row's bytes are never asked for.
    before, after = [np.zeros(len(n), np.uint64)], [np.zeros(len(n), np.uint64)]
    for k in range(cell - 1):
        before.append(pair(before[-1] + K3, flat[np.minimum(begin + np.maximum(ahead - 1 - k, 0), len(flat) - 1)]))
        after.append(pair(after[-1] + K3, flat[np.minimum(begin + ahead + k, len(flat) - 1)]))
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    j = ahead[row] - at  # bytes before the common ones
    ends = pair(np.stack(before)[j, row], np.stack(after)[cell - 1 - j, row])
    return row, at, pair(pair(ends, j.astype(np.uint64)), t["bucket"].to_numpy().view(np.uint64)[row])


def steps_of(bucket: np.ndarray, rows: int, large: bool) -> list[tuple[int, int]]:
    """Begin and end of steps of about so many sorted rows. Rows of a bucket stay together, if it is not a ``large`` one, whose suffixes are counted elsewhere."""
    if large:
        edges = [*range(0, len(bucket), rows), len(bucket)]
        return list(zip(edges, edges[1:]))
    edges = np.append(np.flatnonzero(np.append(True, np.diff(bucket) != 0)), len(bucket)).tolist()
    return [(edges[a], edges[z]) for a, z in pt.slices(np.diff(edges).tolist(), rows)]


def second_refined(cell: int, z: Sizes):
    """Repeated pieces and suffixes; of a bucket too large to be held, each suffix with its bucket of full depth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, large in buckets_in(batches, z.open):
            repeated, undecided, first, open_ = judged(t, large)
            yield spans_of(t, repeated, REPEATED)
            chosen = first & (open_ | large)
            if not chosen.any():
                continue
            whole, undecided = t.filter(pa.array(chosen)), undecided[chosen]
            for begin, end in steps_of(whole["bucket"].to_numpy(), max(1, z.step // cell), large):
                part, open_ = whole.slice(begin, end - begin), undecided[begin:end]
                row, at, bucket = suffix_buckets(part, cell)
                if large:
                    some = np.ones(len(row), bool)
                else:
                    _, back, times = np.unique(bucket, return_inverse=True, return_counts=True)
                    some = (times[back] > 1) & open_[row]
                class_, lo = part["class"].to_numpy()[row][some], (part["lo"].to_numpy()[row] + at)[some]
                n, said = np.ones(len(lo), np.int64), np.full(len(lo), SUFFIX if large else REPEATED)
                yield batch_of({"class": class_, "lo": lo, "n": n, "said": said, "suffix": bucket[some]})

    return run


def packed(docs: DataFrame, schema: str, remembered: int = 0) -> DataFrame:
    """The first columns of ``docs`` as they are, and the last, the text, compressed. With ``remembered`` classes, the first column, a task
    gives each class once, as long as it is remembered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=1), set()
        for b in batches:
            if remembered:
                seen = seen if len(seen) < remembered else set()
                new = [n not in seen and not seen.add(n) for n in b.column(0).to_pylist()]
                b = b.filter(pa.array(new, pa.bool_()))
            texts = [pack.compress(t) for t in b.column(b.num_columns - 1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.binary())], names=b.schema.names)

    return docs.mapInArrow(run, schema)


def covered(spans: list[dict], window: int) -> list[tuple[int, int]]:
    """Maximal ranges of bytes, begin and end, that the windows of some runs cover."""
    lo = np.array([s["lo"] for s in spans])
    end = lo + np.array([s["n"] for s in spans]) - 1 + window
    order = np.argsort(lo, kind="stable")
    lo, end = lo[order], np.maximum.accumulate(end[order])
    at = np.flatnonzero(np.append(True, lo[1:] > end[:-1]))
    return list(zip(lo[at].tolist(), end[np.append(at[1:] - 1, len(lo) - 1)].tolist()))


def cut(docs: DataFrame, window: int, z: Sizes) -> DataFrame:
    """Rows of (id, n_bytes, packed text, spans) without the bytes that the spans cover."""
    schema = "id long, n_bytes long, n_removed long, removed array<struct<begin:long,end:long>>, kept binary"
    kinds = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for whole in batches:
            for begin, end in pt.slices(whole.column(1).to_pylist(), 4 * z.slice):
                b = whole.slice(begin, end - begin)
                kept, ranges = [], []
                for text, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                    text = unpack.decompress(text) if text else b""
                    gone = covered(spans, window) if spans else []
                    edges = [0, *[x for r in gone for x in r], len(text)]
                    kept.append(b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2])) if gone else text)
                    ranges.append([{"begin": a, "end": z} for a, z in gone])
                removed = pa.array([sum(r["end"] - r["begin"] for r in x) for x in ranges], pa.int64())
                columns = [b.column(0), b.column(1), removed, pa.array(ranges, kinds), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_removed", "removed", "kept"])

    return docs.mapInArrow(run, schema)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 400, z: Sizes = Sizes()) -> DataFrame:
    """id, n_bytes, n_removed, removed (ranges of bytes), kept (bytes) for each row.

    A byte is removed if a string of ``window`` bytes that covers it starts anywhere else in the table, too.
    """
    if window < FIRST:
        raise ValueError(f"a window has at least {FIRST} bytes")
    scratch = Scratch(df.sparkSession, "suffixes")
    docs = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("class", F.xxhash64("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    long_ = docs.where(F.col("n_bytes") >= window)

    def refined(rows: DataFrame, work, name: str) -> DataFrame:
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "whole", "class", "lo", F.desc("said"))
        return scratch.written(dealt.mapInArrow(work, FOUND), name, waves=8)

    first = refined(first_rows(long_.select("class", "text"), window, z), first_refined(z), "first")
    asked = first.where(F.col("said") != REPEATED).groupBy("class").agg(F.collect_set(F.struct("lo", "n", "said")).alias("spans"))
    asked = packed(long_.select("class", "text"), "class long, packed binary", z.remembered).join(asked, "class").select("class", "packed", "spans")
    second = refined(second_rows(asked, window, z), second_refined(z.cell_of(window), z), "second")

    # Suffixes of buckets that were too large to be held, counted by their bucket of full depth.
    suffixes = second.where(F.col("said") == SUFFIX).withColumn("place", F.xxhash64("class", "lo"))
    often = suffixes.groupBy("suffix").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a <> b").select("suffix")
    whole = long_.groupBy("class", "n_bytes").count().where("count > 1")
    whole = whole.select("class", F.lit(0).cast("long").alias("lo"), (F.col("n_bytes") - window + 1).cast("int").alias("n"))
    spans = [d.where(F.col("said") == REPEATED).select("class", "lo", "n") for d in (first, second)] + [suffixes.join(often, "suffix").select("class", "lo", "n"), whole]
    gone = reduce(DataFrame.union, spans).groupBy("class").agg(F.collect_set(F.struct("lo", "n")).alias("spans"))
    gone = scratch.written(gone, "spans", waves=2)
    rows = packed(docs.select("id", "class", "n_bytes", "text"), "id long, class long, n_bytes long, packed binary").join(gone, "class", "left")
    return cut(rows.select("id", "n_bytes", "packed", "spans"), window, z)
