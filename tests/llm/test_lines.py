"""Line dedup: the perfect hash, and the operator against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsift.llm import linededup as ld
from postsift.llm.common import Scratch
from postsift.sources import tables


def keys(n, seed=0):
    return np.unique(np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64))


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_perfect_hash_is_minimal(n):
    k = keys(n)
    made = ld.PerfectHash.build(k)
    assert sorted(made.numbers(k).tolist()) == list(range(len(k)))


def test_keys_left_after_all_levels(monkeypatch):
    monkeypatch.setattr(ld, "LEVELS", 1)
    k = keys(500)
    made = ld.PerfectHash.build(k)
    assert len(made.left) and sorted(made.numbers(k).tolist()) == list(range(len(k)))


def plain(rows, min_chars, min_docs):
    def key(line):
        return line.encode().strip(ld.EDGES).lower().decode()

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(ld.NO_ID if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = ld.NO_ID if doc is None else doc
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and max(holders[key(x)]) != own)]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


LONG, UPPER = "x" * 39 + "é", " \t" + "X" * 39 + "é\r"
ROWS = [
    *[(i, f"{LONG}\nown {i}\n\n{LONG}") for i in range(6)],
    (7, UPPER),
    (7, "x" * 39),
    (8, None),
    (8, ""),
    (None, LONG),
    (None, None),
    (9, "y" * 200_000 + "\n" + "z" * 100),
    *[(20 + i, "z" * 100) for i in range(4)],
    (20, "z" * 100),
]


@pytest.mark.parametrize("probes", [65_536, 2])
def test_line_dedup(spark, monkeypatch, probes):
    monkeypatch.setattr(ld, "PROBES", probes)
    monkeypatch.setattr(ld, "ALIKE", probes)
    monkeypatch.setattr(ld, "SHARD", 2)
    df = spark.createDataFrame([(d, t, d, "k") for d, t in ROWS], "doc_id long, text string, doc long, `kept_text` string")
    done = ld.line_dedup(df, min_chars=40, min_docs=5)
    assert done.columns == ["doc_id", "text", "doc", "kept_text", "n_lines", "n_dropped"]
    got = sorted([(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in done.collect()], key=str)
    assert got == plain(ROWS, 40, 5)


def test_empty_table(spark):
    assert ld.line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_few_documents_and_high_counts(spark):
    df = spark.createDataFrame([(i, LONG) for i in range(3)], "doc_id long, text string")
    assert sum(r.n_dropped for r in ld.line_dedup(df, min_docs=2).collect()) == 2
    assert sum(r.n_dropped for r in ld.line_dedup(df, min_docs=300).collect()) == 0


@pytest.mark.parametrize("repeated", ["id", "text"])
def test_an_id_of_a_third_of_the_rows_is_dealt_to_many_groups(spark, monkeypatch, repeated):
    """No group of probes and no joined group of rows grows with the rows of one id, not even if their texts are equal."""
    monkeypatch.setattr(ld, "PROBES", 64)
    monkeypatch.setattr(ld, "SHARD", 64)
    monkeypatch.setattr(ld, "ALIKE", 16)
    sizes = []

    def watch(name, keys):
        made = getattr(ld, name)

        def watched(*args):
            out = made(*args)
            sizes.append(out.groupBy(*keys).count().agg(F.max("count")).first()[0])
            return out

        monkeypatch.setattr(ld, name, watched)

    watch("dealt_probes", ["shard", "copy"])
    watch("dealt_rows", ["doc", "name", "part"])
    rows = [(i, f"{LONG}\n{i:050d}") for i in range(200)]
    rows += [(None if repeated == "id" else 7, LONG + (f"\nown {i}" if repeated == "id" else "")) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in ld.line_dedup(df).collect()], key=str)
    assert got == plain(rows, 40, 5)
    assert len(sizes) == 2 and sizes[0] < 120 and sizes[1] < 30


def test_scratch_tables_are_below_the_folder_that_is_deleted(spark):
    path = Scratch(spark, "lines").path("x")
    assert path.startswith(tables.run_folder(spark) + "/")
