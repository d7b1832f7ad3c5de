"""Exact ranked lexical search: dense blocked multiplication of item weights by document impacts.

1. Terms of items and documents become 64-bit hashes, for whole batches of texts at once. Items are dealt into groups of about ``Sizes.group``
   (item, term) entries; each group is one pass. Its vocabulary is compact: its distinct terms, numbered.
2. A scan of the documents keeps, per document, how often it holds each term of the group's vocabulary, and its number of terms. Document
   frequencies, the number of documents and of terms are partial sums of these rows.
3. Items of a group form blocks of at most ``Sizes.items`` items with a vocabulary of their own, cut into tiles of ``Sizes.columns`` terms. For each
   tile of documents, the item tile (weight times repeats) and the document tile (impacts) are dense float64 matrices, multiplied by BLAS.
   A tile whose weights could sum to 2^53 or more is halved; a single such column is multiplied in 64-bit integers. So every partial sum is exact.
4. A task keeps the best k documents of each item, with all ties at the last place ordered by document id, and sends only these. Ranks are
   numbered by a window per item over k rows of each task.

Nothing is shuffled but document frequencies and the k best. The driver holds one group of items at a time (``Sizes.group`` entries on average, or one
item, if it has more) and never a document; the tasks of a pass get that group in their function. Documents are written once per pass as term numbers.

Exact up to collisions of 64-bit hashes of terms. Defined results: null text has no terms; documents without terms do not count and are never
found; items without terms, or whose terms no document holds, return nothing. Rows that repeat an item id are items of their own. Rows that
repeat a document id are documents of their own and each takes a rank. A null document id comes before all others in ties. Empty tables give
an empty table. Other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsift.llm import pretokens as pt
from postsift.llm.bpe import lengths
from postsift.llm.common import Scratch
from postsift.llm.shingles import BASE, INVERSE, byte_values, mixed, powers

#: Fixed values of the score: parts of a thousand, saturation and length share, largest impact of a term.
THOUSAND, SCALE, SLOPE, LENGTH_SHARE = 1000, 1_000_000_000, 8, 75
TOP_IMPACT = SCALE // THOUSAND
#: Stands for a null id in arrays; no id is smaller.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Sizes:
    """How much is handled at a time; the result is the same for all values."""

    slice: int = 1_000_000  # bytes of text
    group: int = 1 << 17  # entries of the items of a pass
    items: int = 64  # items of a block
    entries: int = 4096  # entries of a block
    columns: int = 4096  # terms of a tile
    docs: int = 256  # documents of a tile
    exact: int = 1 << 53  # double precision counts exactly below this


IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms in order, A-Z as a-z, and where each text's begin, with the end."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    first = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    edge = np.diff(np.concatenate(([False], IS_TERM[data], [False])).astype(np.int8))
    begin, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(byte_values()[data] * powers(BASE, len(data)), dtype=np.uint64)))
    hashes = mixed((sums[end] - sums[begin]) * powers(INVERSE, len(data) + 1)[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(begin, first)


def counted(texts: list[bytes], known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The number of terms of each text, and all (text, term, times) in order, as three arrays.

    ``known``: sorted hashes; terms are their numbers, others are left out. Without it terms are the hashes themselves.
    """
    hashes, borders = term_hashes(texts)
    n = np.diff(borders)
    owner = np.repeat(np.arange(len(texts)), n)
    if known is not None:
        at = np.searchsorted(known, hashes)
        at[at == len(known)] = 0
        same = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
        owner, term = owner[same], at[same].astype(np.uint64)
    else:
        term = hashes
    order = np.lexsort((term, owner))
    owner, term = owner[order], term[order]
    first = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (term[1:] != term[:-1]))[: len(term)])
    return n, owner[first], term[first], np.diff(first, append=len(term))


def packed(texts: list[bytes], known: np.ndarray | None) -> list[pa.Array]:
    """n, terms and times of each text; terms (8 bytes for hashes, 4 for numbers) and times (4 bytes) as binary."""
    n, owner, term, times = counted(texts, known)
    term = term.astype(np.uint64 if known is None else np.uint32)
    borders = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    parts = list(zip(borders[:-1], borders[1:]))
    times = times.astype(np.uint32)
    return [
        pa.array(n, pa.int64()),
        pa.array([term[a:b].tobytes() for a, b in parts], pa.binary()),
        pa.array([times[a:b].tobytes() for a, b in parts], pa.binary()),
    ]


def with_terms(df: DataFrame, known: np.ndarray | None, z: Sizes) -> DataFrame:
    """id, n, terms, times for each row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end in pt.slices(lengths(whole.column(1)).tolist(), z.slice):
                b = whole.slice(begin, end - begin)
                texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), *packed(texts, known)], names=["id", "n", "terms", "times"])

    return df.mapInArrow(run, "id long, n long, terms binary, times binary")


def frequencies(matches: DataFrame, size: int) -> DataFrame:
    """term, df: the number of documents that hold each term; one sum per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            flat = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint32)
            total += np.bincount(flat, minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["term", "df"])

    return matches.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Block:
    """Some items over their own vocabulary: ``weights`` has a row for each item and a column for each term of ``terms``."""

    def __init__(self, items: list[int], entries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, z: Sizes):
        self.items = np.array(items)
        self.terms = np.unique(np.concatenate([t for t, _ in entries]))
        self.weights = np.zeros((len(items), len(self.terms)), np.int64)
        for i, (t, times) in enumerate(entries):
            self.weights[i, np.searchsorted(self.terms, t)] = weight[t] * times
        borders = [*range(0, len(self.terms), z.columns), len(self.terms)]
        self.tiles = [tile for a, b in zip(borders, borders[1:]) for tile in exact_tiles(self.weights, a, b, z.exact)]

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
        """Scores of all items for a tile of documents, given as entries."""
        at = np.searchsorted(self.terms, term)
        at[at == len(self.terms)] = 0
        mine = self.terms[at] == term
        at, doc, impact = at[mine], doc[mine], impact[mine]
        total = np.zeros((len(self.items), docs), np.int64)
        for begin, end, weights in self.tiles:
            inside = slice(None) if len(self.tiles) == 1 else (at >= begin) & (at < end)
            tile = np.zeros((end - begin, docs), weights.dtype)
            tile[at[inside] - begin, doc[inside]] = impact[inside]
            total += (weights @ tile).astype(np.int64)
        return total


def exact_tiles(weights: np.ndarray, begin: int, end: int, exact: int) -> list[tuple[int, int, np.ndarray]]:
    """Ranges of columns whose sums double precision holds exactly; a column too large for that stays in 64-bit integers."""
    part = weights[:, begin:end]
    if int(part.sum(axis=1).max()) * TOP_IMPACT < exact:
        return [(begin, end, part.astype(np.float64))]
    if end - begin == 1:
        return [(begin, end, part)]
    middle = (begin + end) // 2
    return exact_tiles(weights, begin, middle, exact) + exact_tiles(weights, middle, end, exact)


def blocks_of(entries: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, z: Sizes) -> list[Block]:
    """Items in order, in blocks of bounded numbers of items and entries, or of one item."""
    out, begin, total = [], 0, 0
    for i, (t, _) in enumerate(entries):
        if i > begin and (total + len(t) > z.entries or i - begin == z.items):
            out.append((begin, i))
            begin, total = i, 0
        total += len(t)
    if begin < len(entries):
        out.append((begin, len(entries)))
    held = [[i for i in range(a, b) if len(entries[i][0])] for a, b in out]
    return [Block(items, [entries[i] for i in items], weight, z) for items in held if items]


class Best:
    """The best k documents of each item so far: highest scores, then smallest ids."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(items)]
        self.bar = np.ones(items, np.int64)  # scores of zero are never kept

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """A tile of scores; ties with the last place come in, too, as their ids decide."""
        row, column = np.nonzero(scores >= self.bar[items][:, None])
        for r in np.unique(row).tolist():
            own, i = column[row == r], int(items[r])
            s, d = np.append(self.found[i][0], scores[r, own]), np.append(self.found[i][1], ids[own])
            top = np.lexsort((d, -s))[: self.k]
            self.found[i] = s[top], d[top]
            if len(top) == self.k:
                self.bar[i] = s[top[-1]]


def tiles_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, n, and entries (document, term, times) of tiles of at most ``size`` documents."""
    for whole in batches:
        for begin in range(0, whole.num_rows, size):
            b = whole.slice(begin, size)
            terms = b.column(2).to_pylist()
            doc = np.repeat(np.arange(b.num_rows), [len(t) // 4 for t in terms])
            times = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint32).astype(np.int64)
            ids = b.column(0).fill_null(NO_ID).to_numpy()
            yield ids, b.column(1).to_numpy(), doc, np.frombuffer(b"".join(terms), np.uint32).astype(np.int64), times


def impacts(n: np.ndarray, doc: np.ndarray, times: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """What each entry adds per unit of weight, given the numbers of documents and terms of the whole table."""
    m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * docs // terms for x in n.tolist()], np.int64)
    return SCALE * times // (THOUSAND * times + SLOPE * m[doc])


def scored(matches: DataFrame, entries: list, weight: np.ndarray, docs: int, terms: int, k: int, z: Sizes) -> DataFrame:
    """item, doc, score: the best k documents of each task for each item, by the item's place in ``entries``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, best = blocks_of(entries, weight, z), Best(len(entries), k)
        for ids, n, doc, term, times in tiles_of(batches, z.docs):
            impact = impacts(n, doc, times, docs, terms)
            for b in blocks:
                best.add(b.items, b.scores(doc, term, impact, len(ids)), ids)
        item = np.repeat(np.arange(len(entries)), [len(s) for s, _ in best.found])
        score, doc = (np.concatenate([x[i] for x in best.found]) if best.found else np.zeros(0, np.int64) for i in (0, 1))
        ids = pa.array(doc, pa.int64(), mask=doc == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), ids, pa.array(score, pa.int64())], names=["item", "doc", "score"])

    return matches.mapInArrow(run, "item long, doc long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item_key: str = "item_id", text: str = "text", z: Sizes = Sizes()) -> DataFrame:
    """item, rank (from 1), doc, score: for each item the k documents with the highest scores above zero."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical")

    def pairs(df: DataFrame, id_: str) -> DataFrame:
        return df.select(F.col(f"`{id_}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))

    asked = with_terms(pairs(items, item_key), None, z)
    asked = scratch.written(asked.where("n > 0").drop("n"), "items", waves=2)
    total = asked.agg(F.sum(F.length("terms") / 8)).first()[0] or 0
    groups = max(1, math.ceil(total / z.group))
    order = Window.partitionBy("group", "item").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    out = None
    for g in range(groups):
        own = asked.where(F.pmod(F.xxhash64("id", "terms"), F.lit(groups)) == g).orderBy("id", "terms").collect()
        hashes = [np.frombuffer(r.terms, np.uint64) for r in own]
        known = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        entries = [(np.searchsorted(known, h), np.frombuffer(r.times, np.uint32).astype(np.int64)) for h, r in zip(hashes, own)]
        matches = scratch.written(with_terms(pairs(docs, key), known, z).where("n > 0"), f"matches-{g}")
        n_docs, n_terms = matches.agg(F.count("*"), F.sum("n")).first()
        weight = np.zeros(len(known), np.int64)
        if n_docs:
            for term, df in frequencies(matches, len(known)).collect():
                weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        best = scored(matches, entries, weight, n_docs, n_terms or 1, k, z).withColumn("group", F.lit(g))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r.id) for i, r in enumerate(own)], "item long, name long")
        ranked = ranked.join(F.broadcast(names), "item").select(F.col("name").alias("item"), F.col("rank").cast("int").alias("rank"), "doc", "score")
        out = ranked if out is None else out.union(ranked)
    return out
