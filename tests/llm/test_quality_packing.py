"""Quality rules, packing, and the pipeline."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from postsift.llm import packing, quality
from postsift.llm.queries import LLM_QUERIES
from tests.llm.test_ngrams import plain as plain_groups

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_statistics(spark):
    texts = ["Ab c c c! 12 é", "", None, "a\nb\n\na\n", "#" * 70_000, "퟿\U0010ffff"]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, stat_upper int")
    rows = quality.with_statistics(df).collect()
    assert rows[0].stat_upper == pytest.approx(1 / 6) and rows[0].stat_next_same == pytest.approx(1 / 6)
    assert rows[0].stat_digits == pytest.approx(2 / 9) and rows[0].stat_exclaims == pytest.approx(1 / 6)
    assert rows[3].stat_lines_again == pytest.approx(1 / 3) and rows[4].stat_symbols == 1
    assert all(rows[i][c] == 0 for i in (1, 2) for c in quality.STATISTICS)


def test_rules_compile_to_columns(spark):
    model = quality.RuleModel([quality.Rule((("stat_upper", True, 0.5), ("stat_digits", False, 0.1)))], [2.0], -1.0)
    df = spark.createDataFrame([(0.5, 0.2), (0.6, 0.2), (0.5, 0.1)], "stat_upper double, stat_digits double")
    score = lambda z: 1 / (1 + np.exp(-z))
    for m in (model, quality.RuleModel.from_json(model.to_json())):
        assert [r[0] for r in df.select(m.score()).collect()] == pytest.approx([score(1.0), score(-1.0), score(-1.0)])


def test_no_labels_and_one_class(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    stats = quality.with_statistics(df)
    for labels, want in (([], 0.5), ([(i, 1) for i in range(20)], 1.0), ([(i, 0) for i in range(20)], 0.0), ([(1, None), (None, 1)], 0.5)):
        model = quality.fit(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {r[0] for r in stats.select(model.score()).collect()} == {want}


def test_learns_only_from_its_folds(spark):
    df = spark.createDataFrame([(i,) for i in range(100)] + [(None,)], "doc_id long").select("doc_id", quality.held_out(F.col("doc_id")).alias("h"))
    assert all(r.h == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0) for r in df.collect())


def test_op7_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = LLM_QUERIES["op7_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n, right = rows.agg(F.count("*"), F.count_if(F.col("predicted") == F.col("quality"))).first()
    assert n > 30 and right / n >= 0.95


def assert_packed(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


LENGTHS = {
    "uniform": np.random.default_rng(0).integers(1, 2049, 3000),
    "small": np.minimum(2048, np.random.default_rng(1).lognormal(5, 1, 3000).astype(int) + 1),
    "same": np.full(500, 1100),
    "threes": np.random.default_rng(2).integers(500, 800, 600),
    "full": np.full(9, 2048),
    "one": np.array([1]),
    "none": np.zeros(0, int),
}


@pytest.mark.parametrize("name", LENGTHS)
def test_packed(name):
    sizes = LENGTHS[name]
    found = packing.packed(sizes, 2048)
    assert sorted(i for s in found for i in s) == list(range(len(sizes)))
    assert all(sizes[s].sum() <= 2048 for s in found)
    assert len(found) <= len(packing.best_fit(sizes.tolist(), 2048))
    if name in ("small", "full", "one", "none"):
        assert len(found) <= -(-int(sizes.sum()) // 2048) + 1


def test_search_empties_a_sequence():
    """Best fit needs three sequences of ten, an exchange makes two do."""
    sizes = np.array([4, 4, 3, 3, 3, 3])
    search = packing.Search([[0, 1], [2, 3, 4], [5]], sizes, 10)
    search.run(1)
    assert sorted(sorted(sizes[s].tolist()) for s in search.sequences()) == [[3, 3, 4], [3, 3, 4]]


def test_search_goes_on_until_no_exchange_is_left():
    """Sequences that resist do not end the search while others have exchanges."""
    r = np.random.default_rng(5)
    sizes = np.minimum(2048, r.lognormal(np.log(490), 0.6, 3500).astype(int) + 1)
    assert len(packing.best_fit(sizes.tolist(), 2048)) > -(-int(sizes.sum()) // 2048) == len(packing.packed(sizes, 2048))
    sizes = r.integers(350, 561, 700)
    found = packing.packed(sizes, 2048)
    fill = [int(sizes[s].sum()) for s in found]
    for v, own in enumerate(found):
        gives = [sizes[i] for i in own] + [sizes[i] + sizes[j] for k, i in enumerate(own) for j in own[k + 1 :]]
        for to, others in enumerate(found):
            nets = np.subtract.outer(gives, sizes[others]).ravel() if to != v else np.zeros(0, int)
            nets = np.append(nets, sizes[own] if to != v else [])
            assert not ((nets > 0) & (nets <= 2048 - fill[to]) & (fill[to] - fill[v] + nets > 0)).any()


def test_bad_lengths():
    for bad in ([0], [2049]):
        with pytest.raises(ValueError, match="between 1 and 2048"):
            packing.packed(np.array(bad), 2048)


@pytest.mark.parametrize("group", [32_768, 40])
def test_cut_and_pack(spark, sf, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP", group)
    library = Tokenizer.from_file(BYTES)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(900, None), (901, ""), (902, "long text " * 6000), (903, "x"), (903, "x"), (None, "<|endoftext|>")], docs.schema)
    docs = docs.union(extra)
    pieces = packing.cut(docs, BYTES)
    assert pieces.columns == ["doc_id", "piece", "start", "length", "ids"]
    rows = pieces.collect()
    want = []
    for r in docs.collect():
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(r.doc_id, k, a, b - a, ids[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda t: str(t[:4])
    assert sorted([(r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows], key=key) == sorted(want, key=key)
    done = packing.pack(pieces.drop("ids").withColumn("offset", F.lit("clash"))).collect()
    assert sorted(str((r.doc_id, r.piece, r.start, r.length)) for r in done) == sorted(str(w[:4]) for w in want)
    n = assert_packed(done)
    if group > 1000:
        assert n <= -(-sum(w[3] for w in want) // 2048) + 1


def test_pack_empty(spark):
    assert packing.pack(spark.createDataFrame([], "length long")).count() == 0


def test_pipeline_stages(spark, sf):
    """Each stage against plain Python on its own input, and the whole run."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "packing"] and corpus_pipeline.ORACLE_SQL is None
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = corpus_pipeline.quality_stage(spark, docs, sf).persist()
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    wrong = [d for d, q in labels.items() if (d in ids) != (q == 1)]
    assert len(wrong) <= 0.05 * len(labels)

    from tests.llm.test_lines import plain as plain_lines

    lines = corpus_pipeline.line_stage(spark, kept, sf).persist()
    assert lines.columns == docs.columns
    want = {d: t for d, t, _, _ in plain_lines([(r.doc_id, r.text) for r in kept.collect()], 40, 5)}
    rows = lines.collect()
    assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)

    near = corpus_pipeline.near_stage(spark, lines, sf).persist()
    assert near.columns == docs.columns
    groups = {d: c for d, _, c in plain_groups([(r.doc_id, r.text) for r in rows])}
    assert sorted(r.doc_id for r in near.collect()) == sorted(d for d, c in groups.items() if d == c)

    packed = corpus_pipeline.packing_stage(spark, near, sf).collect()
    assert_packed(packed)
    assert {r.doc_id for r in packed} == {r.doc_id for r in near.collect()}
    run = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r[:5] for r in run) == sorted(r[:5] for r in packed)
    assert corpus_pipeline.packing_stage(spark, corpus_pipeline.near_stage(spark, corpus_pipeline.line_stage(spark, docs.limit(0), sf), sf), sf).count() == 0
