"""N-gram Jaccard join against all pairs of sets, and connected components."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsift.llm import ngramjoin, shingles
from postsift.llm.common import Scratch
from postsift.llm.components import connected

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text, width=5):
    words = WORDS.findall((text or "").encode().lower())
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def roots_of(n, linked):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                root[find(a)] = find(b)
    return [find(a) for a in range(n)]


def plain(rows, percent=75):
    sets = [shingle_set(t) for _, t in rows]
    roots = roots_of(len(rows), lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
    out = []
    for (doc, _), s, r in zip(rows, sets, roots):
        ids = [rows[b][0] for b in range(len(rows)) if roots[b] == r and rows[b][0] is not None]
        out.append((doc, len(s), min(ids) if s and ids else doc))
    return sorted(out, key=str)


def near_copies(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for g in range(12):
        base = [word() for _ in range(rng.randint(3, 120))]
        for c in range(rng.choice([1, 2, 15])):
            own = [word() if rng.random() < 0.01 * (c % 5) else w for w in base]
            rows.append((len(rows) + 10, rng.choice([" ", "\n", "\t "]).join(own) + (" " + passage if g % 3 == 0 else "")))
    rows += [(1, ""), (2, None), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, "A\x0bb c\r\nd"), (None, "one"), (None, None), (10, rows[0][1])]
    rows += [(500 + i, "x " * 50) for i in range(8)] + [(8, "b" * 5000 + " c d e f"), (9, " ".join(f"w{i}" for i in range(20_000)))]
    return rows


@pytest.mark.parametrize("sizes", [(4_000_000, 512, 12, 400_000, 250_000), (300, 3, 2, 400_000, 20), (2000, 512, 4, 200, 1), (300, 512, 4, 200, 5)])
def test_jaccard_join(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "TILE", "FEW", "ENTRIES", "HOT"), sizes):
        monkeypatch.setattr(ngramjoin, name, value)
    rows = near_copies()
    df = spark.createDataFrame([(d, t, 0, 0) for d, t in rows], "doc_id long, text string, n long, class long")
    got = ngramjoin.jaccard_join(df)
    assert got.columns == ["doc", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_bound_is_exact(spark):
    """Three of four shingles in common is a link, a little less is not."""
    base = [f"w{i}" for i in range(11)]  # seven shingles
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-1], "x"])), (3, " ".join(base[:9])), (4, " ".join(["y", *base]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (60, 75, 76, 87, 88, 100):
        assert sorted(tuple(r) for r in ngramjoin.jaccard_join(df, percent=percent).collect()) == plain(rows, percent)


def test_empty(spark):
    assert ngramjoin.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shingle_hashes():
    texts = [t for _, t in near_copies(3)]
    sets = shingles.sets([(t or "").encode() for t in texts])
    seen = {}
    for text, own in zip(texts, sets):
        plain_set = shingle_set(text)
        assert len(own) == len(plain_set) and (np.diff(own.astype(object)) > 0).all()
        seen.setdefault(frozenset(plain_set), set()).add(own.tobytes())
    assert all(len(x) == 1 for x in seen.values()) and len({x for y in seen.values() for x in y}) == len(seen)
    assert shingles.sets([]) == []


def test_components(spark):
    rng = random.Random(4)
    nodes = rng.sample(range(10_000), 150)
    pairs = list(zip(nodes[:60], nodes[1:61])) + [(rng.choice(nodes[70:]), rng.choice(nodes[70:])) for _ in range(50)] + [(5, 5)]
    both = {frozenset(p) for p in pairs}
    names = sorted({x for p in pairs for x in p})
    roots = roots_of(len(names), lambda a, b: frozenset((names[a], names[b])) in both)
    want = {n: min(m for m, s in zip(names, roots) if s == r) for n, r in zip(names, roots)}
    links = spark.createDataFrame(pairs, "a long, b long")
    assert dict(tuple(r) for r in connected(links, Scratch(spark, "test-components")).collect()) == want
    assert connected(links.limit(0), Scratch(spark, "test-components")).count() == 0


def test_a_shingle_of_a_third_of_the_texts_is_dealt_to_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BLOCK", 2000)
    monkeypatch.setattr(ngramjoin, "HOT", 30)
    seen, plain_incidence = [], ngramjoin.incidence

    def watched(docs, width, blocks, hot, parts):
        out = plain_incidence(docs, width, blocks, hot, parts)
        sizes = out.groupBy("block").agg((F.sum(F.length("columns")) / 4).alias("n")).collect()
        seen.append((len(hot), parts, max(r.n for r in sizes)))
        return out

    monkeypatch.setattr(ngramjoin, "incidence", watched)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(f"w{i} v{j}" for j in range(8)) + (" " + passage if i % 3 == 0 else "")) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngramjoin.jaccard_join(df).collect()), key=str)
    assert got == plain(rows)
    ((hot, parts, largest),) = seen
    assert hot >= 36 and parts > 2 and largest < 4500  # 36 columns of 200 rows each would make 7200


def test_frequent_columns_are_found_in_little_memory(monkeypatch):
    monkeypatch.setattr(ngramjoin, "COUNTED", 50)
    rng = np.random.default_rng(0)
    often = ngramjoin.Frequent()
    for _ in range(100):
        often.add([np.unique(np.concatenate((rng.integers(100, 2000, 20), np.arange(10)))).astype(np.uint64) for _ in range(30)])
        assert len(often.columns) <= 50
    assert set(range(10)) <= set(often.columns.tolist()) and often.counts[:10].min() > 1500
