"""Top-k search and near-duplicate vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsift.llm import nearvec, topk


def frame(spark, rows, extra="id long, dims long, filter long"):
    schema = f"vec_id long, embedding array<float>, label int, {extra}"
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, 0, 0, 0) for i, v, l in rows], schema)


def plain_top(rows, asks, k, scale=1024):
    good = []
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)))
    out = []
    for i, q in good:
        if asks(i):
            scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in good if j != i and len(w) == len(q))
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(8192, 256), (7, 2)])
def test_top_k(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "ROWS", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    monkeypatch.setattr(topk, "START", 2)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 4, 6) / 7, 0) for i in range(60)]
    rows = [(i, v.tolist(), 0) for i, v, _ in rows]
    rows += [(100, None, 0), (110, [0.1, None], 0), (120, [float("nan")] * 6, 0), (130, [float("inf")] * 6, 0), (None, [0.5] * 6, 0), (140, [], 0)]
    rows += [(10, rows[10][1], 0), (10, rows[11][1], 0), *[(33, rows[33][1], 0)] * 3, *[(44, (-np.array(rows[44][1])).tolist(), 0)] * 6, (150, [1.0, 2.0], 0), (151, [0.5, 0.5], 0), (160, [1.0], 0)]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, k=4)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, lambda i: i % 10 == 0, 4)


def test_top_k_ends_early_and_large_numbers():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.standard_normal((3000, 5)) * 50)
    rows[7] *= 100
    ids = np.arange(3000)
    depths = []
    for (places, scores, depth), q in zip(topk.best(rows, topk.sorted_lists(rows), ids, rows[:20], ids[:20], 10), range(20)):
        want = sorted((-int(rows[j] @ rows[q]), j) for j in range(3000) if j != q)[:10]
        assert [(-s, j) for s, j in zip(scores.tolist(), places.tolist())] == want
        depths.append(depth)
    assert min(depths) < 1500
    big = (rows * 2**18).astype(np.int64)
    places, scores, _ = topk.plain_best(big, ids, big[0], 0, 3)
    assert scores.tolist() == sorted((int(x) for x in big[1:] @ big[0]), reverse=True)[:3]


def test_few_entries_are_read_of_clustered_vectors():
    """Two of 16 topics each: a list has little to add after an eighth of it."""
    rng = np.random.default_rng(2)
    rows = np.zeros((4096, 16))
    for _ in range(2):
        rows[np.arange(4096), rng.integers(0, 16, 4096)] = rng.integers(1, 1000, 4096)
    ids = np.arange(4096)
    found = topk.best(rows, topk.sorted_lists(rows), ids, rows[:50], ids[:50], 5)
    assert np.mean([depth for _, _, depth in found]) < 0.5 * 4096
    for (places, scores, _), q in zip(found, range(50)):
        want = sorted((-int(rows[j] @ rows[q]), j) for j in range(4096) if j != q)[:5]
        assert [(-s, j) for s, j in zip(scores.tolist(), places.tolist())] == want


def test_top_k_empty(spark):
    assert topk.top_k(frame(spark, []), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(frame(spark, [(1, [1.0], 0)]), F.col("vec_id") == 1).count() == 0


def plain_near(rows, bound):
    """id, n_links, component_id, kept of all pairs."""
    n = len(rows)
    ok = [i is not None and l is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for i, v, l in rows]
    x = [np.array(v, np.float32).astype(float) if o else None for o, (_, v, _) in zip(ok, rows)]
    links = [
        [a != b and ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.linalg.norm(x[a]) / np.linalg.norm(x[b]) >= bound for b in range(n)]
        for a in range(n)
    ]
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            c = todo.pop()
            new = [b for b in range(n) if links[c][b] and b not in seen]
            seen.update(new)
            todo += new
        known = [rows[b][0] for b in seen if rows[b][0] is not None]
        component = min(known) if known else None
        out.append((rows[a][0], sum(links[a]), component, component is None or rows[a][0] == component))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile", [1024, 3])
def test_near_duplicates(spark, monkeypatch, tile):
    monkeypatch.setattr(nearvec, "TILE", tile)
    monkeypatch.setattr(nearvec, "CELL", 50)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((6, 16))
    rows = [(100 + i, (base[i % 6] + 0.02 * (i % 9) * rng.standard_normal(16) / 4).tolist(), i % 2) for i in range(60)]
    rows += [(rows[0][0], rows[0][1], rows[0][2]), (3, rows[1][1], rows[1][2]), (4, (np.array(rows[1][1]) * 1e-30).tolist(), rows[1][2])]
    rows += [(5, None, 0), (6, [0.0] * 16, 0), (7, [None] * 16, 0), (8, [float("inf")] * 16, 0), (9, rows[1][1], None), (None, rows[1][1], 1), (10, [1.0], 0), (11, [2.0], 0), (12, [], 0)]
    got = nearvec.near_duplicates(frame(spark, rows))
    assert got.columns == ["id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_near(rows, 0.98)


def test_near_duplicates_empty(spark):
    assert nearvec.near_duplicates(frame(spark, [])).count() == 0
    (r,) = nearvec.near_duplicates(frame(spark, [(1, None, 1)])).collect()
    assert tuple(r) == (1, 0, 1, True)


@pytest.mark.parametrize("largest,dims", [(100, 64), (5000, 64), (100_000, 48), (500, 3)])
def test_recall(largest, dims):
    """Pairs with a cosine of exactly 0.98, which is where most are missed."""
    rng = np.random.default_rng(9)
    a, b = rng.standard_normal((2, 500, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    found = zip(nearvec.decode(a, largest), nearvec.decode(0.98 * a + np.sqrt(1 - 0.98**2) * b, largest))
    recall = np.mean([len(np.intersect1d(x, y)) > 0 for x, y in found])
    assert recall >= 0.99


def test_decoding_lists_every_filter_above_the_bound():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((50, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rotation, books, bound = nearvec.code(16, 300, 0.98)
    first, second = books
    turned = x @ rotation
    sums = (turned[:, :8] @ first.T)[:, :, None] + (turned[:, 8:] @ second.T)[:, None, :]
    for row, listed in zip(sums.reshape(50, -1), nearvec.decode(x, 300)):
        least = min(bound, np.sort(row)[-nearvec.LISTED])
        assert set(np.flatnonzero(row >= least + 1e-7)) <= set(listed.tolist()) <= set(np.flatnonzero(row >= least - 1e-7))
