"""Features, clusters, validity, classifier, evaluation, monitoring, and the job as a whole."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsift.functions import vectors as vx
from postsift.operators import classify, clusters, evaluate, features, keywords, language, monitor, reports, validity
from postsift.plans import queries, triage
from postsift.schema import CATEGORY_MAP
from postsift.settings import ClassifierSettings, ClusterSettings, FeatureSettings, Settings, TextSettings, settings_from_json, settings_json
from postsift.streaming import incremental

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def points(spark):
    return queries.split_vectors(spark, SF).cache()


def matrix(df, column):
    return np.array([r[0] for r in df.select(column).collect()])


def test_pca_is_centred_and_uncorrelated_on_the_fit_split(points):
    fit = points.where("split = 'discovery'")
    pca = features.fit_pca(fit, "embedding", FeatureSettings(pca_components=8))
    x = matrix(features.reduce_vectors(fit, pca), "x")
    assert np.abs(x.mean(axis=0)).max() < 1e-9
    cov = np.cov(x.T)
    assert np.abs(cov - np.diag(np.diag(cov))).max() < 1e-9
    raw = matrix(fit, "embedding").astype(float)
    s = np.linalg.svd(raw - raw.mean(axis=0), compute_uv=False) ** 2
    assert math.isclose(features.explained_variance(pca), s[:8].sum() / s.sum(), rel_tol=1e-6)


def test_pca_components_are_capped(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([0.0, 1.0, 5.0],)], "embedding array<double>")
    assert len(features.fit_pca(df).stages[-1].explainedVariance) == 2
    with pytest.raises(ValueError):
        features.fit_pca(df.limit(0))


def test_one_split_does_not_change_with_the_others(points):
    fit = points.where("split = 'discovery'")
    pca = features.fit_pca(fit, "embedding", FeatureSettings(pca_components=4))
    alone = features.reduce_vectors(points.where("split = 'validation'"), pca).select("vec_id", "x")
    within = features.reduce_vectors(points, pca).where("split = 'validation'").select("vec_id", "x")
    assert alone.exceptAll(within).isEmpty()


def test_every_label_is_the_nearest_centre(points):
    model = clusters.fit_kmeans(points, "embedding", 5)
    centres = np.array(model.clusterCenters())
    for v, c in clusters.assign_clusters(points, model, "embedding").select("embedding", "cluster_id").collect():
        d = ((np.array(v) - centres) ** 2).sum(axis=1)
        assert d[c] <= d.min() + 1e-9


def test_too_few_vectors(spark, points):
    with pytest.raises(clusters.TooFewVectors):
        clusters.fit_kmeans(points.limit(3), "embedding", 5)
    model = clusters.fit_kmeans(points, "embedding", 2)
    assert clusters.assign_clusters(points.limit(0), model, "embedding").count() == 0


def test_keywords_tie_order_and_share_limits(spark):
    rows = [("a", "zeta beta"), ("a", "beta zeta alpha"), ("b", None)]
    df = spark.createDataFrame(rows, "g string, t string")
    top = keywords.top_keywords(df, "g", "t", 3).orderBy("rank").collect()
    assert [(r.term, r.n) for r in top] == [("beta", 2), ("zeta", 2), ("alpha", 1)]
    shared = keywords.top_keywords_by_document_share(df, "g", "t", 9, max_share=0.5).collect()
    assert {r.term for r in shared} == {"alpha", "zeta beta", "beta zeta", "zeta alpha"}


def test_pruned_pairs_give_the_same_keywords(spark, sf):
    """One group holds most texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.when(F.col("doc_id") % 5 > 0, "hot").otherwise(F.col("source")).alias("g"), "text"
    )
    plain = {}
    for g, text in docs.collect():
        words = [w for w in re.findall(r"\w{2,}", text.lower())]
        counts = plain.setdefault(g, {})
        for term in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            counts[term] = counts.get(term, 0) + 1
    want = {g: sorted(c.items(), key=lambda x: (-x[1], x[0]))[:12] for g, c in plain.items()}
    got = {}
    for r in keywords.top_keywords(docs, "g", "text", 12).orderBy("g", "rank").collect():
        got.setdefault(r.g, []).append((r.term, r.n))
    assert got == want


def test_rare_terms_go_only_in_large_groups(spark):
    rows = [("a", f"common w{i:03d}") for i in range(101)]
    got = keywords.top_keywords_by_document_share(spark.createDataFrame(rows, "g string, t string"), "g", "t", 9, max_share=1.0)
    assert [r.term for r in got.collect()] == ["common"]


def test_sampling_is_stable_and_bounded(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("c"))
    a = clusters.sample_per_cluster(df, "c", "id", 7).select("id")
    b = clusters.sample_per_cluster(df.repartition(5), "c", "id", 7).select("id")
    assert a.count() == 21 and a.exceptAll(b).isEmpty()


def test_report_markers_and_text(spark):
    rows = [(1, 0, "hello there", "hello there"), (2, 0, None, " "), (3, None, "x", "y")]
    df = spark.createDataFrame(rows, "tweet_id long, cluster_id int, text string, text_preprocessed string")
    r = reports.cluster_report(df, n_samples=5)
    got = {x.cluster_id: x for x in r.collect()}
    assert got[0].n_rows == 2 and got[0].keywords == ["hello", "hello there", "there"]
    shown = {(s.text, s.text_preprocessed) for s in got[0].samples}
    assert shown == {("hello there", "hello there"), (reports.MISSING_TEXT, reports.BLANK_TEXT)}
    assert got[None].n_rows == 1
    text = {x.cluster_id: x.report for x in reports.report_text(r).collect()}[0]
    assert text.startswith("== cluster 0 (2 rows) ==") and text.endswith("name: " + reports.NAME_SLOT)


def test_category_map_belongs_to_a_model(spark):
    with pytest.raises(ValueError):
        clusters.category_table(spark, {9: "x"}, k=8)
    names = clusters.category_table(spark, {0: "x"}, k=8)
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "tweet_id long, cluster_id int")
    out = clusters.label_clusters(df, names)
    assert {r.tweet_id: r.category for r in out.collect()} == {1: "x", 2: None, 3: None}
    assert {(r.cluster_id, r.n_rows) for r in clusters.unmapped_clusters(out).collect()} == {(1, 1), (None, 1)}


def test_too_many_clusters_for_one_value_is_an_error(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(5)], "cluster_id int, category string")
    with pytest.raises(Exception, match="more than 3 rows"):
        clusters.label_clusters(df.drop("category"), df, max_clusters=3).collect()


def test_validity_indices_against_numpy(points):
    x = matrix(points, "embedding").astype(float)
    y = matrix(points, "label")
    ks = np.unique(y)
    centres = np.array([x[y == k].mean(axis=0) for k in ks])
    within = sum(((x[y == k] - c) ** 2).sum() for k, c in zip(ks, centres))
    between = sum((y == k).sum() * ((c - x.mean(axis=0)) ** 2).sum() for k, c in zip(ks, centres))
    ch = (between / (len(ks) - 1)) / (within / (len(x) - len(ks)))
    s = [np.linalg.norm(x[y == k] - c, axis=1).mean() for k, c in zip(ks, centres)]
    worst = [
        max((s[i] + s[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(len(ks)) if j != i)
        for i in range(len(ks))
    ]
    assert math.isclose(validity.calinski_harabasz(points, "label", "embedding").first()[0], ch, rel_tol=1e-6)
    assert math.isclose(validity.davies_bouldin(points, "label", "embedding").first()[0], np.mean(worst), rel_tol=1e-6)
    assert math.isclose(validity.within_cluster_sum(points, "label", "embedding").first()[0], within, rel_tol=1e-6)


def test_sweep_marks_what_does_not_apply(spark, points):
    small = points.limit(6)
    got = {r.k: r for r in validity.sweep_k(small, "embedding", (1, 2, 9)).collect()}
    assert got[1].wcss is not None and got[1].silhouette is None
    assert got[2].davies_bouldin is not None
    assert got[9].wcss is None
    one = small.withColumn("c", F.lit(0))
    assert validity.silhouette_cosine(one, "c", "embedding") is None
    assert validity.calinski_harabasz(one, "c", "embedding").first()[0] is None
    assert validity.davies_bouldin(one, "c", "embedding").first()[0] is None


def test_one_against_rest_minimises_the_stated_objective(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(90, 3)) + np.repeat(np.eye(3) * 2, [60, 20, 10], axis=0)
    y = np.repeat([0, 1, 2], [60, 20, 10])
    df = spark.createDataFrame([("abc"[c], r.tolist()) for c, r in zip(y, x)], "category string, x array<double>")
    model = classify.fit_classifier(df, s=ClassifierSettings(c=1.0))
    xb = np.c_[x, np.ones(len(x))]
    for c, m in enumerate(model.stages[:-1]):
        t = np.where(y == c, 1.0, -1.0)
        weight = np.where(y == c, 90 / (3 * (y == c).sum()), 1.0)
        w = np.zeros(4)
        for _ in range(50):  # Newton
            p = 1 / (1 + np.exp(t * (xb @ w)))
            g = w - xb.T @ (weight * t * p)
            h = np.eye(4) + (xb * (weight * p * (1 - p))[:, None]).T @ xb
            w = w - np.linalg.solve(h, g)
        assert np.allclose(m.coefficients.toArray(), w, atol=1e-4)


def assert_solved(rows, model, scored):
    """Coefficients and predictions of one-against-rest models are those that Newton's method finds for the same rows."""
    train = rows.where("split = 'discovery' and category is not null").select("category", "x").collect()
    names = classify.known_labels(model)
    xb = np.c_[np.array([r.x for r in train]), np.ones(len(train))]
    y = np.array([names.index(r.category) for r in train])
    solved = []
    for c, m in enumerate(model.stages[:-1]):
        t, w = np.where(y == c, 1.0, -1.0), np.zeros(xb.shape[1])
        weight = np.where(y == c, len(y) / (len(names) * (y == c).sum()), 1.0)
        for _ in range(100):
            p = 1 / (1 + np.exp(t * (xb @ w)))
            h = np.eye(len(w)) + (xb * (weight * p * (1 - p))[:, None]).T @ xb
            w = w - np.linalg.solve(h, w - xb.T @ (weight * t * p))
        assert np.allclose(m.coefficients.toArray(), w, atol=1e-3)
        solved.append(w)
    all_ = scored.select("x", "predicted_category").collect()
    margins = np.c_[np.array([r.x for r in all_]), np.ones(len(all_))] @ np.array(solved).T
    clear = np.diff(np.sort(margins, axis=1)[:, -2:], axis=1)[:, 0] > 1e-2
    assert clear.mean() > 0.95
    assert [r.predicted_category for r, k in zip(all_, clear) if k] == [names[i] for i, k in zip(margins.argmax(axis=1), clear) if k]


@pytest.mark.parametrize("family", ["ovr", "multinomial"])
def test_classifier_learns_planted_classes(spark, family):
    """Eight classes of unequal size in 50 dimensions; half of the rows are held out."""
    rng = np.random.default_rng(7)
    y = np.repeat(np.arange(8), [600, 400, 300, 200, 200, 150, 100, 50])
    x = rng.normal(size=(len(y), 50)) + rng.normal(size=(8, 50))[y] * 0.8
    df = spark.createDataFrame([(int(i), f"c{c}", r.tolist()) for i, (c, r) in enumerate(zip(y, x))], "i int, category string, x array<double>")
    model = classify.fit_classifier(df.where("i % 2 = 0"), s=ClassifierSettings(family=family))
    held = classify.predict(df.where("i % 2 = 1"), model)
    assert evaluate.accuracy(held, "category", "predicted_category", []).first().accuracy >= 0.95


@pytest.mark.parametrize("family", ["ovr", "multinomial"])
def test_classifier_learns_clusters_and_survives_saving(spark, tmp_path, family):
    rows = queries.clustered_categories(spark, SF).cache()
    model = classify.fit_classifier(rows.where("split = 'discovery'"), s=ClassifierSettings(family=family))
    scored = classify.predict(rows, model)
    if family == "ovr":
        assert_solved(rows, model, scored)
    assert scored.where("confidence < 0 or confidence > 1").isEmpty()
    model.write().overwrite().save(str(tmp_path / "m"))
    again = classify.predict(rows, type(model).load(str(tmp_path / "m")))
    assert again.select("vec_id", "predicted_category").exceptAll(scored.select("vec_id", "predicted_category")).isEmpty()
    assert classify.known_labels(model) == sorted(classify.known_labels(model))


def test_two_classes_are_one_problem_with_both_weights(spark):
    rng = np.random.default_rng(1)
    y = np.repeat([0, 1], [70, 10])
    x = rng.normal(size=(80, 2)) + y[:, None]
    df = spark.createDataFrame([("ab"[c], r.tolist()) for c, r in zip(y, x)], "category string, x array<double>")
    model = classify.fit_classifier(df)
    got = model.stages[0].coefficients.toArray()
    xb, t, weight, w = np.c_[x, np.ones(80)], 2.0 * y - 1, np.where(y == 1, 4.0, 80 / 140), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(t * (xb @ w)))
        h = np.eye(3) + (xb * (weight * p * (1 - p))[:, None]).T @ xb
        w = w - np.linalg.solve(h, w - xb.T @ (weight * t * p))
    assert np.allclose(got, w, atol=1e-4)
    want = np.where(xb @ w > 0, "b", "a")
    assert [r.predicted_category for r in classify.predict(df, model).collect()] == list(want)


def test_no_training_data(spark):
    with pytest.raises(classify.NoTrainingData):
        classify.fit_classifier(spark.createDataFrame([], "category string, x array<double>"))


def test_report_counts_and_zero_division(spark):
    rows = [("s", "a", "a"), ("s", "a", "b"), ("s", "b", "b"), ("s", "c", "a")]
    df = spark.createDataFrame(rows, "split string, t string, p string")
    got = {r["class"]: r for r in evaluate.class_report(df, "t", "p").collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].support) == (0.5, 0.5, 2)
    assert (got["c"].precision, got["c"].recall, got["c"].f1) == (0.0, 0.0, 0.0)
    assert got["accuracy"].f1 == 0.5 and got["accuracy"].support == 4
    assert math.isclose(got["macro avg"].f1, (0.5 + 2 / 3 + 0) / 3)
    text = evaluate.report_text(evaluate.class_report(df, "t", "p")).first().report
    assert text.splitlines()[0].split() == ["precision", "recall", "f1", "support"]
    assert [x.split()[0] for x in text.splitlines()[1:]] == ["a", "b", "c", "accuracy", "macro", "weighted"]


def test_splits_with_unseen_labels_are_listed_and_skipped(spark):
    rows = [("x", "a"), ("y", "a"), ("y", "new"), ("y", None)]
    df = spark.createDataFrame(rows, "split string, category string")
    kept, unseen = evaluate.evaluable(df, ["a", "b"])
    assert [r.split for r in kept.collect()] == ["x"]
    assert [(r.split, r.category, r.n_rows) for r in unseen.collect()] == [("y", "new", 1)]


def test_stability_index(spark):
    a = spark.createDataFrame([(0,)] * 5 + [(1,)] * 5, "b int")
    same = monitor.stability_index(a, a, "b").agg(F.sum("psi")).first()[0]
    moved = monitor.stability_index(a, a.where("b = 1"), "b").agg(F.sum("psi")).first()[0]
    assert same == 0.0 and moved > 1


def test_user_encoder_and_blank_text(spark):
    df = spark.createDataFrame([("aab",), ("",), (None,)], "text_preprocessed string")
    got = [r.embedding for r in features.encode_with(df, queries.letter_shares, 26).collect()]
    assert got[0][:2] == pytest.approx([2 / 3, 1 / 3]) and sum(got[1]) == 0 and sum(got[2]) == 0


def test_word2vec_vocabulary_is_bounded(spark):
    df = spark.createDataFrame([("a b c d",)] * 9, "text_preprocessed string")
    with pytest.raises(ValueError):
        features.fit_word2vec_encoder(df, max_words=3)


@pytest.fixture(scope="module")
def trained(spark):
    s = Settings(features=FeatureSettings(hashing_dims=64, pca_components=8))
    raw = queries.messages(spark, SF)
    texts = triage.prepared(raw, s).withColumn("detected_language", F.lit("en"))
    texts = triage.preprocessed(texts, None, s).cache()
    found = triage.discover(texts, s, k=4)
    labelled = triage.pseudo_label(texts, found, {0: "a", 1: "b", 2: "c", 3: "d"})
    return s, texts, found, labelled, triage.train(labelled, found)


def test_whole_job(spark, trained, tmp_path):
    s, texts, found, labelled, model = trained
    done = triage.evaluate_all(labelled, model)
    acc = {r.split: r for r in done.accuracy.collect()}
    assert acc["discovery"].accuracy > 0.85
    report = done.report.where(F.col("class") == "accuracy").collect()
    assert {r.split: r.support for r in report} == {k: v.n_rows for k, v in acc.items()}
    wrong = sum(round((1 - r.accuracy) * r.n_rows) for r in acc.values())
    assert done.errors.count() == wrong and done.unseen.isEmpty()
    named = found.report(texts)
    assert named.agg(F.sum("n_rows")).first()[0] == texts.where("split = 'discovery'").count()
    model.save(str(tmp_path / "t"))
    again = triage.Triage.load(spark, str(tmp_path / "t"))
    cols = ["tweet_id", "predicted_category"]
    a, b = (m.score_texts(texts).select(*cols) for m in (model, again))
    assert a.exceptAll(b).isEmpty()


def test_pseudo_labelled_columns(trained):
    cols = clusters.pseudo_labelled(trained[3]).columns
    assert cols[:5] == ["tweet_id", "text", "text_preprocessed", "cluster_id", "category"]
    assert "x" not in cols and "author_id" in cols


def test_scoring_needs_no_shuffle(spark, trained):
    new = queries.messages(spark, SF).withColumn("detected_language", F.lit("en"))
    plan = trained[4].score(new)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_new_files_are_scored_once(spark, trained, tmp_path):
    model = trained[4]
    src, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))
    new = queries.messages(spark, SF).withColumn("detected_language", F.lit("en"))
    new.where("tweet_id < 20000").write.parquet(src)
    stream = incremental.new_messages(spark, src, new.schema)
    incremental.score_new_files(stream, model, out, mark).awaitTermination()
    first = spark.read.parquet(out).count()
    assert first == new.where("tweet_id < 20000 and inbound").count()
    new.where("tweet_id >= 20000").write.mode("append").parquet(src)
    incremental.score_new_files(stream, model, out, mark).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == new.where("inbound").count() == got.select("tweet_id").distinct().count()


def test_recluster_recent_messages(trained):
    s, texts, *_ = trained
    found, report = triage.recluster(texts, "2017-01-01", s, k=3)
    assert report.count() <= 3 and len(found.kmeans.clusterCenters()) <= 3


def test_saved_triage_brings_its_settings_and_names(spark, tmp_path):
    from dataclasses import replace

    s = Settings(text=replace(TextSettings(), expand_chat_words=False, convert_emoticons=False), clusters=ClusterSettings(k=2))
    assert settings_from_json(settings_json(s)) == s
    docs = spark.createDataFrame(
        [(i, f"{'red apple fruit' if i % 2 else 'fast new car'} thx {i % 5}", "discovery", "en") for i in range(40)],
        "tweet_id long, text string, split string, detected_language string",
    )
    s = replace(s, features=FeatureSettings(hashing_dims=32, pca_components=4))
    texts = triage.preprocessed(docs, s=s)
    found = triage.discover(texts, s)
    model = triage.train(triage.pseudo_label(texts, found, {0: "a", 1: "b"}), found)
    model.save(str(tmp_path / "m"))
    again = triage.Triage.load(spark, str(tmp_path / "m"))
    assert again.discovery.settings == s and again.categories == {0: "a", 1: "b"}
    score = lambda m: {r.tweet_id: (r.predicted_category, r.text_preprocessed) for r in m.score(docs).collect()}
    assert score(again) == score(model) and "thanks" not in str(score(again))
    spark.createDataFrame([(5, "c")], CATEGORY_MAP).write.mode("overwrite").parquet(str(tmp_path / "m" / "categories"))
    with pytest.raises(ValueError, match="has 2"):
        triage.Triage.load(spark, str(tmp_path / "m"))


def test_keywords_of_very_many_groups(spark):
    df = spark.range(12_000).selectExpr("id as grp", "concat('alpha beta alpha beta w', id) as text")
    top = keywords.top_keywords(df, "grp", "text", 2)
    assert top.count() == 24_000 and {r.term for r in top.where("rank = 1").collect()} == {"alpha"}


def test_language_model_keeps_every_trigram(spark):
    letters = [chr(0x4E00 + i) for i in range(45)]
    rare = spark.range(45**2).selectExpr("id")
    rows = [(a + b + c, "zh") for a in letters for b in letters for c in letters]
    df = spark.createDataFrame(rows + [("plain words here", "en")], "text string, lang string")
    model = language.fit_language_model(df)
    assert rare.count() and len(model.stages[0].vocabulary) > 65_536
    with pytest.raises(ValueError, match="trigrams"):
        language.fit_language_model(df, max_counts=100)


def test_language_table_has_no_bound_and_the_same_answers(spark, tmp_path, monkeypatch):
    letters = [chr(0x4E00 + i) for i in range(12)]
    rows = [(a + b + c, "zh") for a in letters for b in letters for c in letters] + [("the cat sat on the mat", "en"), ("el gato y el sombrero", "es")]
    df = spark.createDataFrame(rows, "text string, lang string")
    with pytest.raises(ValueError, match="trigrams"):
        language.fit_language_model(df, max_counts=100)
    collected, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: collected.append(collect(self)) or collected[-1])
    table = language.fit_language_table(df)
    assert max(map(len, collected)) == 3  # a row for each language
    monkeypatch.undo()
    table.save(str(tmp_path / "languages"))
    table = language.LanguageTable.load(spark, str(tmp_path / "languages"))
    odd = [("",), (None,), ("12 :)",), ("the cat",), ("el gato",), ("gato the",), (letters[3] * 9,), ("zzz",), ("the cat",)]
    texts = df.select("text").union(spark.createDataFrame(odd, "text string")).withColumn("_key", F.lit(None).cast("string"))
    small = language.detect_language(texts, language.fit_language_model(df), "text").groupBy("text", "detected_language").count()
    large = language.detect_language(texts, table, "text").groupBy("text", "detected_language").count()
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)
    with pytest.raises(ValueError, match="0 languages"):
        language.fit_language_table(df.where("false"))


def test_language_scores_by_a_shuffled_join(spark):
    """Weights that are too large to be broadcast give the same scores."""
    df = queries.ingest.assign_split(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    table = language.fit_language_table(df.where("split = 'discovery'"))
    here = language.detect_language(df, table, "text").select("doc_id", "detected_language").collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        there = language.detect_language(df, table, "text").select("doc_id", "detected_language").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(here) == sorted(there) and len(here) == df.count()


def test_a_table_that_is_too_large_for_one_value_raises(spark):
    big = spark.range(200).selectExpr("id as a", "id as b")
    for packed in (vx.as_one_value(big, "a", "b", max_rows=50), vx.as_one_map(big, "a", "b", max_rows=50)):
        with pytest.raises(Exception, match="more than 50 rows"):
            spark.range(1).select(packed).collect()
    assert len(spark.range(1).select(vx.as_one_value(big, "a", max_rows=200)).first()[0]) == 200


def test_sweep_shares_its_passes(spark, monkeypatch):
    """All k step together from MLlib's first centres, and end where MLlib's own fit of each k ends."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 4)) + rng.choice([-3, 0, 3], size=(400, 1))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(3).localCheckpoint()
    fit, asked = clusters.fit_kmeans, []
    monkeypatch.setattr(clusters, "fit_kmeans", lambda *a, **o: asked.append((a[0], o["max_iter"])) or fit(*a, **o))
    got = {r.k: r for r in validity.sweep_k(df, "x", (2, 3, 7)).collect()}
    assert [most for _, most in asked] == [0, 0, 0]
    written = asked[0][0]  # first centres follow from the partitions
    for k in got:
        model = fit(written, "x", k)
        labelled = clusters.assign_clusters(written, model, "x")
        assert math.isclose(got[k].wcss, model.summary.trainingCost, rel_tol=1e-9)
        assert math.isclose(got[k].silhouette, validity.silhouette_cosine(labelled, "cluster_id", "x"), rel_tol=1e-9)
