"""Exact top-k inner products without random access to the lists.

Rows are dealt into blocks, and each component of a block is sorted once: that is its list. For one query the lists are read
from the end that adds most, all of them to the same depth, which starts at ``START`` entries and doubles. What a row has added so far,
plus the least or the most that the unread rest of its lists can add, bounds its score from below and above. Rows whose upper bound is
under the k-th largest lower bound are out, and so are all unseen rows once the sum of the last entries read is under it. Reading
stops when no outsider can qualify; the scores of the few rows still in are then resolved. Blocks of queries meet
blocks of rows, and the best k of each block go on to a ranking per query. The queries of a block read on together until each has
stopped, so that a stretch adds its new entries, of the rows that have any, by two matrix products.

Each packed block travels once per block of queries, each query once per block of rows, and k rows per query and block come back, so
no task holds more than one block of each.

Defined results: scores are integers, exact below 2^63. Vectors that are null, empty, or hold nulls or non-finite
components, and rows without an id, take no part. Only vectors of as many components as the query's are compared with it.
Every row counts: a row that repeats an id and its vector takes a rank of its own, and a query that is repeated gets its list as often.
Rows of the query's id are never its result. A query with fewer than k others gets all. Ties go to the smaller id. Empty tables give
empty tables. Copies of an id and its vector are counted before anything is shuffled, and only ranks up to k are written out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.llm.common import Scratch

#: Rows and queries in a block; entries of each list that are read first; the largest number that double precision counts exactly up to.
ROWS, QUERIES, START, EXACT = 8192, 256, 64, 1 << 53


def sorted_lists(rows: np.ndarray) -> np.ndarray:
    """Each component's list, as places of rows from its least value."""
    return np.argsort(rows, axis=0, kind="stable").astype(np.int32)


def best(rows: np.ndarray, order: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """For each query the places and scores of the best k rows of a block whose id is not the query's, and the depth read."""
    n, columns = len(rows), np.arange(rows.shape[1])
    rank = np.empty_like(order)
    rank[order, columns] = np.arange(n, dtype=np.int32)[:, None]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)  # read from the end, and from the beginning
    low_end, high_end = rows[order[0], columns], rows[order[-1], columns]
    known = np.zeros((len(queries), n))
    out: list = [None] * len(queries)
    going, depth = np.arange(len(queries)), 0
    while len(going):
        before, depth = depth, min(n, max(START, 2 * depth))
        q_up, q_down = up[going], down[going]
        # New entries only: those of ranks beyond what was read, of the rows that have any.
        new_up, new_down = (rank >= n - depth) & (rank < n - before), (rank < depth) & (rank >= before)
        touched = np.flatnonzero((new_up | new_down).any(axis=1))
        part = rows[touched]
        known[np.ix_(going, touched)] += q_up @ (part * new_up[touched]).T + q_down @ (part * new_down[touched]).T
        # Unread entries of a list add at most what the last one read did, and at least what the list's other end does.
        read_up, read_down = rank >= n - depth, rank < depth
        seen = np.flatnonzero((read_up | read_down).any(axis=1))
        most_up, most_down = q_up * rows[order[n - depth], columns], q_down * rows[order[depth - 1], columns]
        least_up, least_down = q_up * low_end, q_down * high_end
        unread_up, unread_down = ~read_up[seen].T, ~read_down[seen].T
        sums = known[np.ix_(going, seen)]
        most = sums + most_up @ unread_up + most_down @ unread_down
        low = sums + least_up @ unread_up + least_down @ unread_down
        unseen = (most_up + most_down).sum(axis=1)
        still = []
        for j, i in enumerate(going.tolist()):
            inside = np.flatnonzero(ids[seen] != own[i])
            wanted = min(k, len(inside))
            left = seen[inside]
            if wanted:
                bar = np.partition(low[j, inside], -wanted)[-wanted]
                left = left[most[j, inside] >= bar - 0.5]  # scores are whole numbers
            outsiders = len(seen) < n and (wanted < k or unseen[j] >= bar - 0.5)
            if depth < n and (outsiders or len(left) > 4 * k):
                still.append(i)
                continue
            scores = rows[left].astype(np.int64) @ queries[i].astype(np.int64)
            top = np.lexsort((left, ids[left], -scores))[:k]
            out[i] = (left[top], scores[top], depth)
        going = np.array(still, np.int64)
    return out


def plain_best(rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The same from all scores, for components too large to bound in double precision."""
    inside = np.flatnonzero(ids != own)
    scores = rows[inside] @ query
    top = np.lexsort((inside, ids[inside], -scores))[:k]
    return inside[top], scores[top], len(rows)


def packed_block(rows: pa.Table) -> pa.Table:
    """One row: a block's ids, how often each row is there, vectors and lists."""
    vectors = np.array(rows["ints"].combine_chunks().flatten(), np.int64).reshape(rows.num_rows, -1)
    parts = {c: rows[c].to_numpy() for c in ("id", "row", "n")} | {"vectors": vectors, "lists": sorted_lists(vectors)}
    out = {c: pa.array([v.tobytes()], pa.binary()) for c, v in parts.items()}
    return pa.table({"dims": rows["dims"].slice(0, 1), "block": rows["block"].slice(0, 1), **out})


PACKED = "dims int, block int, id binary, row binary, n binary, vectors binary, lists binary"
FOUND = {c: pa.int64() for c in ("query_id", "query_row", "times", "vec_id", "vec_row", "n", "score", "depth")}


def block_best(block: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The best k rows of one packed block for each query of a block."""
    out: dict[str, list] = {c: [] for c in FOUND}
    if block.num_rows and queries.num_rows:
        dims = block["dims"][0].as_py()
        ids, row, n, vectors = (np.frombuffer(block[c][0].as_py(), np.int64) for c in ("id", "row", "n", "vectors"))
        vectors = vectors.reshape(-1, dims)
        order = np.frombuffer(block["lists"][0].as_py(), np.int32).reshape(-1, dims)
        asked = np.array(queries["ints"].combine_chunks().flatten(), np.int64).reshape(-1, dims)
        own = queries["id"].to_numpy()
        if 4.0 * float(np.abs(vectors).max()) * float(np.abs(asked).max()) * dims < EXACT:
            found = best(vectors.astype(float), order, ids, asked.astype(float), own, k)
        else:  # bounds in double precision would not be exact
            found = [plain_best(vectors, ids, q, i, k) for q, i in zip(asked, own)]
        named = zip(own.tolist(), queries["row"].to_pylist(), queries["n"].to_pylist())
        for (places, scores, depth), asks in zip(found, named):
            values = (*asks, ids[places], row[places], n[places], scores, depth)
            for c, v in zip(FOUND, values):
                out[c] += v.tolist() if isinstance(v, np.ndarray) else [v] * len(places)
    return pa.table({c: pa.array(v, FOUND[c]) for c, v in out.items()})


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def top_k(df: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for the rows that ``is_query`` marks, the k best other rows.

    Score: inner product of the components, each times ``scale`` and rounded down.
    """
    scratch = Scratch(df.sparkSession, "topk")
    v = F.col(f"`{vector}`")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = df.where(sound & F.col(f"`{key}`").isNotNull())
    rows = rows.select(F.col(f"`{key}`").cast("long").alias("id"), whole_numbers(v, scale).alias("ints"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    named = rows.select("*", F.xxhash64("ints").alias("row"), F.size("ints").alias("dims"))
    rows = named.groupBy("id", "row", "dims", "ints").agg(F.max("asks").alias("asks"), F.count("*").alias("n"))
    rows = scratch.written(rows, "rows", waves=2)
    n, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, asking = max(1, math.ceil(n / ROWS)), max(1, math.ceil(asked / QUERIES))

    def dealt(name: str, of: int) -> Column:
        return F.pmod(F.xxhash64("id", "row", F.lit(name)), F.lit(of)).cast("int").alias(name)

    def each(name: str, of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1))).alias(name)

    packed = rows.select("dims", dealt("block", blocks), "id", "row", "n", "ints").groupBy("dims", "block").applyInArrow(packed_block, PACKED)
    packed = scratch.written(packed, "blocks", waves=2).select("*", each("part", asking))
    queries = rows.where("asks").select("dims", dealt("part", asking), "id", "row", "n", "ints").select("*", each("block", blocks))
    sides = [side.groupBy("dims", "block", "part") for side in (packed, queries)]
    found = sides[0].cogroup(sides[1]).applyInArrow(lambda a, b: block_best(a, b, k), ", ".join(f"{c} long" for c in FOUND))
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    ranked = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    ranked = ranked.withColumn("until", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.col("until") - F.col("n"))
    ranked = ranked.where(F.col("before") < k).withColumn("rank", F.explode(F.sequence(F.col("before") + 1, F.least(F.col("until"), F.lit(k)))))
    ranked = ranked.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
