"""Ranked lexical search against plain Python over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from postsift.llm import lexsearch

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().lower())


def plain(docs, items, k=10):
    """Rows (item, rank, doc, score) as the definition has them."""
    held = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for doc, c in held:
            m = 100 - 75 + 75 * c.total() * n_docs // n_terms
            score = 0
            for t, times in asked.items():
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def tables(seed=4):
    rng = random.Random(seed)
    words = ["été", "Ab", "ab", "x1", "σ", "ΣΤ", "the", "the", "the", "quick", "naïve", "日本語", "z" * 300, "a_b", "don't"]
    text = lambda n: rng.choice([" ", ", ", "\n", "_", "\x7f"]).join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(150)]
    docs += [(500 + i, docs[3][1]) for i in range(25)]  # ties beyond the last place
    docs += [(3, docs[3][1]), (3, "quick"), (None, docs[3][1]), (None, None), (900, None), (901, ""), (902, " .,-"), (903, "the " * 30_000)]
    items = [(i, text(rng.randint(1, 30))) for i in range(40)]
    items += [(1, "quick quick"), (1, docs[3][1]), (1, docs[3][1]), (None, "été"), (70, None), (71, ""), (72, "unheard"), (73, "the " * 5000 + "quick")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"group": 60, "items": 3, "columns": 2, "docs": 7, "slice": 500}, {"exact": 5_000_000, "entries": 9}])
def test_search(spark, sizes):
    docs, items = tables()
    left = spark.createDataFrame([(d, t, 0, 1) for d, t in docs], "doc_id long, text string, score long, rank int").repartition(5)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id long")
    got = lexsearch.search(left, right, z=lexsearch.Sizes(**sizes))
    assert got.columns == ["item", "rank", "doc", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs, items)


def test_fewer_documents_than_places(spark):
    docs, items = [(1, "a b"), (2, "b c")], [(1, "b"), (2, "c"), (3, "d")]
    found = lexsearch.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, None)], [(1, "a")])])
def test_empty(spark, docs, items):
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert lexsearch.search(left, right).collect() == []


def test_tiles_sum_exactly():
    """No float tile could reach 2^53; the tiles cover all columns once."""
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 1 << 33, (5, 40))
    tiles = lexsearch.exact_tiles(weights, 0, 40, 1 << 53)
    assert [b for b, _, _ in tiles] == [0, *[e for _, e, _ in tiles[:-1]]] and tiles[-1][1] == 40
    for begin, end, part in tiles:
        assert (part == weights[:, begin:end]).all()
        if part.dtype == np.float64:
            assert int(weights[:, begin:end].sum(axis=1).max()) * lexsearch.TOP_IMPACT < 1 << 53
        else:
            assert end - begin == 1
