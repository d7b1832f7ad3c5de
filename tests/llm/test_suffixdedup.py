"""Removal of repeated byte strings against a count of all windows."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from postsift.llm import suffixdedup


def plain(rows, window):
    """Rows (id, n_bytes, n_removed, ranges, kept) from all windows of all texts."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        edge = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(bytes(gone), np.uint8), [0])).astype(int)))
        ranges = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), ranges, kept))
    return sorted(out, key=str)


def found(spark, rows, window, **sizes):
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in rows], "doc_id long, text string, n long, class string").repartition(4)
    got = suffixdedup.remove_repeats(df, window=window, z=suffixdedup.Sizes(**sizes))
    assert got.columns == ["id", "n_bytes", "n_removed", "removed", "kept"]
    return sorted(((r.id, r.n_bytes, r.n_removed, [tuple(x) for x in r.removed], bytes(r.kept)) for r in got.collect()), key=str)


def corpus(window, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 7)))
    text = lambda n: "".join(word() for _ in range(n))
    passages = [text(window // 2) for _ in range(4)]
    rows = []
    for i in range(60):
        t = text(rng.randint(0, window))
        for _ in range(rng.choice([0, 0, 1, 2])):  # passages cut anywhere, so that some are a byte too short
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            t += p[a : a + window + rng.choice([-2, -1, 0, 1, 5, 60])] + text(rng.randint(0, 20))
        rows.append((i, t))
    for i in range(25):  # near copies
        t = rows[i % 3 + 5][1]
        at = rng.randint(0, len(t))
        rows.append((100 + i, t[:at] + rng.choice(["", "x", "é"]) + t[at + 1 :]))
    rows += [(200 + i, rows[0][1] + passages[0]) for i in range(8)]
    rows += [(1, rows[0][1]), (None, passages[1]), (None, None), (300, None), (301, ""), (302, "a" * (window - 1)), (303, "b" * window)]
    rows += [(304, "c" * (window + 1)), (305, "xy" * window + "é" + "xy" * window), (306, "z" * 3000), (307, "".join(f"{k} " for k in range(4000)))]
    return rows


SIZES = [(400, {}), (64, {}), (100, {"slice": 700, "part": 150, "remembered": 5}), (40, {"open": 3, "slice": 900}), (33, {"open": 40, "cell": 5}), (8, {"cell": 1, "open": 9})]


@pytest.mark.parametrize("window, sizes", SIZES)
def test_remove_repeats(spark, window, sizes):
    rows = corpus(window, window)
    assert found(spark, rows, window, **sizes) == plain(rows, window)


def test_one_byte_decides(spark):
    """Strings of exactly the window's length, or a byte less, in common, at the edges of texts and inside."""
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    common = letters(400)
    rows = [(1, common), (2, letters(50) + common + letters(60)), (3, common[1:]), (4, letters(30) + common[:-1]), (5, letters(399))]
    assert found(spark, rows, 400) == plain(rows, 400)
    assert {r[0]: r[2] for r in plain(rows, 400)} == {1: 400, 2: 400, 3: 0, 4: 0, 5: 0}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "short"), (1, "short")]])
def test_little(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.id, r.n_removed) for r in suffixdedup.remove_repeats(df).collect()] == [(d, 0) for d, _ in rows]


def test_buckets_of_any_depth():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 3000, dtype=np.uint8).tobytes()
    for depth in (8, 9, 15, 16, 31, 100, 400):
        places = np.arange(len(data) - depth + 1)
        got = suffixdedup.Buckets(data, 400).of(places, depth)
        names = [data[i : i + depth] for i in places]
        assert len(set(got.tolist())) == len(set(names)) == len(set(zip(names, got.tolist())))


def test_least_ahead():
    v = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 7, 200):
        assert suffixdedup.least_ahead(v, width).tolist() == [min(v[i : i + width]) for i in range(200 - width + 1)]
    assert len(suffixdedup.least_ahead(v, 201)) == 0


def test_memory_of_a_slice():
    """What a slice takes does not follow from its size: levels that nothing asks for go, and parts are worked through in steps."""
    rng = np.random.default_rng(5)
    parts = [rng.integers(97, 123, 2000, dtype=np.uint8).tobytes() for _ in range(500)]
    tracemalloc.start()
    got = suffixdedup.runs(parts, 400, 32, suffixdedup.Sizes().step)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6  # 1 MB of text
    whole = suffixdedup.runs(parts, 400, 32, 1 << 30)
    assert all((got[c] == whole[c]).all() for c in whole)


def test_steps_of_a_crowded_table():
    """Steps are bounded where rows need not meet, and hold whole buckets where they must."""
    bucket = np.repeat(np.arange(6), [3, 1, 9, 2, 2, 1])
    assert suffixdedup.steps_of(bucket, 4, False) == [(0, 4), (4, 13), (13, 17), (17, 18)]
    assert suffixdedup.steps_of(np.zeros(10), 4, True) == [(0, 4), (4, 8), (8, 10)]


def test_small_steps(spark):
    rows = corpus(40, 11)
    assert found(spark, rows, 40, open=3, slice=900, step=130) == plain(rows, 40)
    assert found(spark, rows, 40, open=50, cell=4, step=40) == plain(rows, 40)
