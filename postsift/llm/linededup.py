"""Exact removal of lines that recur in many documents, by a sharded minimal perfect hash.

1. Each document yields the 128-bit digests of its distinct long lines; two aggregations give, per digest, the number of
   documents holding it and the largest of their ids.
2. Digests are dealt into shards by hash. A shard is a minimal perfect hash over its digests (levels of bit arrays: a
   digest whose bit no other one wants is placed, the rest go on to the next level) and arrays in that order: a 32-bit
   fingerprint, the count, and the keeper's id for those that recur often enough.
3. Documents send digests, not lines, to the shards and probe the arrays. A shard with many probes, as of a line that a
   third of all documents hold, is replicated and its probes, counted row by row, are dealt over the replicas by row.
4. Only the digests that a row drops come back, under the name of that row (a hash of id and text); each text is filtered once.

No group is larger than a shard or ``PROBES`` probes on average, also if one id, or one id with one text, holds a third of the rows: rows
of one id have names of their own, and a name of very many rows is salted. The names that are salted have more than a ``NAMES``-th part of all
rows each, so that no more than ``NAMES`` are broadcast. The digests and counts are written to the shared folder, so a lost executor
costs its running tasks.

Defined results: null or empty text is one empty line. Rows with the same id are one document, and each returns its own
row; a null id is an id of its own, smaller than all others. An empty table gives an empty table. Lines equal to each other
after the key function count once per document and are dropped together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.common import Scratch

#: White space that a line's key loses at both ends.
EDGES = b" \t\n\x0b\x0c\r"
#: Digests in a shard, and probes that one task compares with a copy of it.
SHARD, PROBES = 32_768, 65_536
#: Bits per digest of a level, and levels before what is left is listed.
SPREAD, LEVELS = 2.0, 24
#: Rows of one name that one task joins; names that may be salted.
ALIKE, NAMES = 4096, 100_000
#: Keeper of a line that only documents with a null id hold.
NO_ID = -(1 << 63)


def digest(line: bytes, min_chars: int) -> bytes | None:
    """Digest of a line's key, or None if the key is too short: edges stripped, A-Z in lower case."""
    key = line.strip(EDGES).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each 64-bit key in a level of ``size`` bits."""
    x = keys + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of each digest, and its 32-bit fingerprint."""
    both = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return both[:, 0], (both[:, 1] >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Numbers 0..n-1 for n distinct 64-bit keys, from bit arrays and, in case, a short sorted list."""

    def __init__(self, levels: list[bytes], sizes: list[int], left: np.ndarray):
        self.levels = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(levels, sizes)]
        self.packed, self.sizes, self.left = levels, sizes, left

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, sizes = [], []
        while len(keys) and len(levels) < LEVELS:
            size = max(8, int(len(keys) * SPREAD))
            at = positions(keys, len(levels), size)
            wanted = np.bincount(at, minlength=size)
            levels.append(np.packbits(wanted == 1).tobytes())
            sizes.append(size)
            keys = keys[wanted[at] != 1]
        return cls(levels, sizes, np.sort(keys))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some keys that are not in the set, any number for others."""
        out = np.full(len(keys), -1, np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, bits in enumerate(self.levels):
            at = positions(keys[open_], level, len(bits))
            hit = bits[at] == 1
            rank = np.cumsum(bits, dtype=np.int64)
            out[open_[hit]] = base + rank[at[hit]] - 1
            base += int(rank[-1])
            open_ = open_[~hit]
        if len(self.left) and len(open_):
            at = np.minimum(np.searchsorted(self.left, keys[open_]), len(self.left) - 1)
            same = self.left[at] == keys[open_]
            out[open_[same]] = base + at[same]
        return out


INDEX = "shard long, n long, sizes array<long>, levels array<binary>, rest binary, fingerprints binary, counts binary, keepers binary"


def build_shard(rows: pa.Table, min_docs: int) -> dict:
    """One row with the perfect hash and the arrays of a shard."""
    key, fingerprint = halves(rows["digest"].to_pylist())
    count, keeper = rows["n_docs"].to_numpy(), rows["keeper"].to_numpy()
    made = PerfectHash.build(key)
    number = made.numbers(key)
    fingerprints, counts = np.zeros(len(key), np.uint32), np.zeros(len(key), np.int64)
    fingerprints[number], counts[number] = fingerprint, count
    keepers = np.zeros(len(key), np.int64)
    keepers[number] = keeper
    counts = np.minimum(counts, 255 if min_docs <= 255 else 0xFFFFFFFF)
    return {
        "shard": rows["shard"][0].as_py(),
        "n": len(key),
        "sizes": made.sizes,
        "levels": made.packed,
        "rest": made.left.tobytes(),
        "fingerprints": fingerprints.tobytes(),
        "counts": counts.astype(np.uint8 if min_docs <= 255 else np.uint32).tobytes(),
        "keepers": keepers[counts >= min_docs].tobytes(),
    }


def probe(index: dict, digests: list[bytes], docs: np.ndarray, min_docs: int) -> np.ndarray:
    """Which (digest, document) pairs are to be dropped. Every digest is one of the index."""
    key, fingerprint = halves(digests)
    made = PerfectHash(index["levels"], index["sizes"], np.frombuffer(index["rest"], np.uint64))
    number = made.numbers(key)
    if (number < 0).any() or (np.frombuffer(index["fingerprints"], np.uint32)[number] != fingerprint).any():
        raise ValueError("a line is missing from the index")
    often = np.frombuffer(index["counts"], np.uint8 if min_docs <= 255 else np.uint32) >= min_docs
    keeper = np.zeros(len(often), np.int64)
    keeper[often] = np.frombuffer(index["keepers"], np.int64)
    return often[number] & (keeper[number] != docs)


def line_digests(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc, name, salt, digest: the distinct long lines of each row, and one entry without a digest for the row itself.

    ``salt`` numbers the rows of a task, so that rows that are alike can be told apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for b in batches:
            found, counts = [], []
            for text in b["text"].cast(pa.binary()).to_pylist():
                own = {digest(line, min_chars) for line in (text or b"").split(b"\n")} - {None}
                found += [None, *own]
                counts.append(1 + len(own))
            of = pa.array(np.repeat(np.arange(b.num_rows), counts))
            salt = pa.array(((row + np.arange(b.num_rows)) % (1 << 30)).astype(np.int32))
            row += b.num_rows
            columns = [b["doc"].take(of), b["name"].take(of), salt.take(of), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "name", "salt", "digest"])

    return docs.select("doc", "name", "text").mapInArrow(run, "doc long, name long, salt int, digest binary")


def dealt_probes(probes: DataFrame, copies: DataFrame) -> DataFrame:
    """Probes with the copy of their shard that they go to, by row."""
    of = F.coalesce(F.col("copies"), F.lit(1))
    return probes.join(copies, "shard", "left").withColumn("copy", F.pmod(F.xxhash64("doc", "name", "salt"), of).cast("int"))


def dealt_rows(docs: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows with a part of their name; one part but for the names in ``hot``."""
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce(F.col("parts"), F.lit(1))).cast("int")
    return docs.join(hot, ["doc", "name"], "left").withColumn("part", part).drop("parts")


def drop_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """Each row with the lines left over, given the digests that it drops."""
    schema = docs.select("row").schema.add("kept_text", "string").add("n_lines", "long").add("n_dropped", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, total, gone = [], [], []
            for text, drops in zip(b["text"].cast(pa.binary()).to_pylist(), b["drops"].to_pylist()):
                lines = (text or b"").split(b"\n")
                left = lines
                if drops:
                    unwanted = set(drops)
                    left = [x for x in lines if digest(x, min_chars) not in unwanted]
                kept.append(b"\n".join(left))
                total.append(len(lines))
                gone.append(len(lines) - len(left))
            new = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
            yield pa.RecordBatch.from_arrays([b["row"], *new], names=["row", "kept_text", "n_lines", "n_dropped"])

    return docs.select("row", "text", "drops").mapInArrow(run, schema)


def line_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``df`` with ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped``.

    Lines are split at \\n. Lines whose key has at least ``min_chars`` code points and is found in at least ``min_docs``
    documents are dropped everywhere but in the document with the largest id holding it.
    """
    new = ("kept_text", "n_lines", "n_dropped")
    rest = [c for c in df.columns if c not in new]
    scratch = Scratch(df.sparkSession, "lines")
    id_, body = F.col(f"`{key}`").cast("long"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    docs = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), F.coalesce(id_, F.lit(NO_ID)).alias("doc"), body.alias("text"))
    docs = docs.withColumn("name", F.xxhash64("text"))

    written = scratch.written(line_digests(docs, min_chars), "digests", waves=8)
    lines = written.where("digest is not null")
    held = lines.groupBy("doc", "digest").agg(F.count("*").alias("n_rows"))
    counted = held.groupBy("digest").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"), F.sum("n_rows").alias("n_rows"))
    counted = scratch.written(counted, "counted", waves=2)
    shards = max(1, math.ceil(counted.count() / SHARD))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")
    counted = counted.select("digest", "n_docs", "keeper", "n_rows", shard)

    def index_of(rows: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([build_shard(rows, min_docs)], INDEX_ARROW)

    index = counted.drop("n_rows").groupBy("shard").applyInArrow(index_of, INDEX)
    copies = counted.groupBy("shard").agg(F.ceil(F.sum("n_rows") / PROBES).alias("copies")).where("copies > 1")
    index = index.join(copies, "shard", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("copies"), F.lit(1)).cast("int") - 1)))
    probes = dealt_probes(lines.select("doc", "name", "salt", "digest", shard), copies)

    def probed(asked: pa.Table, of: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return asked.select(["doc", "name", "digest"])
        found = probe(of.to_pylist()[0], asked["digest"].to_pylist(), asked["doc"].to_numpy(), min_docs)
        return asked.select(["doc", "name", "digest"]).filter(pa.array(found))

    pairs = probes.select("shard", "copy", "doc", "name", "digest").groupBy("shard", "copy")
    drops = pairs.cogroup(index.drop("copies").groupBy("shard", "copy")).applyInArrow(probed, "doc long, name long, digest binary")
    # The lines of one text at most, and one set of them per partition, however many rows have it.
    drops = drops.groupBy("doc", "name").agg(F.collect_set("digest").alias("drops"))

    rows = written.where("digest is null")
    alike = max(ALIKE, rows.count() // NAMES)
    hot = rows.groupBy("doc", "name").agg(F.count("*").alias("n")).where(F.col("n") > alike)
    hot = F.broadcast(scratch.written(hot.select("doc", "name", F.ceil(F.col("n") / ALIKE).cast("int").alias("parts")), "alike", waves=1))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    docs = dealt_rows(docs, hot)
    drops = drops.join(hot, ["doc", "name"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    joined = docs.join(drops.drop("parts"), ["doc", "name", "part"], "left")
    return drop_lines(joined, min_chars).select("row.*", *new)


INDEX_ARROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("n", pa.int64()),
        ("sizes", pa.list_(pa.int64())),
        ("levels", pa.list_(pa.binary())),
        ("rest", pa.binary()),
        ("fingerprints", pa.binary()),
        ("counts", pa.binary()),
        ("keepers", pa.binary()),
    ]
)
