"""One query per operator over the shared test tables.

The tables stand in for message data: ``conversations`` (role ``user`` = inbound), ``documents`` (texts with
a language), ``pages`` (markup and links), ``embeddings`` (vectors with a cluster label), ``events``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.functions import lexicons as lx
from postsift.functions import text as tx
from postsift.functions import vectors as vx
from postsift.operators import (
    classify,
    clusters,
    evaluate,
    features,
    ingest,
    keywords,
    language,
    lemmas,
    monitor,
    normalise,
    paradigms,
    prepare,
    reports,
    spelling,
    tokenmap,
    validity,
)
from postsift.plans import triage
from postsift.settings import LANGUAGES, ClassifierSettings, FeatureSettings, Settings, TextSettings
from postsift.sources import quoted, shipping, tables
from postsift.streaming import first, incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Names for eight of the ten cluster labels of the embeddings table; two stay unnamed.
CATEGORIES = {
    0: "orders",
    1: "thanks",
    2: "feedback",
    3: "technical",
    4: "unreadable",
    5: "accounts",
    6: "transport",
    7: "dialogue",
}

# Appended to messages so that the emoticon and chat-word steps have something to do; one per language.
DECORATION = {
    "en": " lol :) thx u 😀 😲",
    "es": " xfa salu2 :-( <3",
    "fr": " mdr bcp XD 🚀",
    "de": " vlt thx ;-) :P",
    "pt": " vc obg :D ☀",
    "it": " cmq grz ^_^ :O",
    "nl": " lol :) 😀",
    "ru": " thx <3",
}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def users(spark: SparkSession, sf: str) -> DataFrame:
    conv = tables.spread(table(spark, sf, "conversations"), "conv_id", "turn")
    conv = conv.withColumn("inbound", F.col("role") == "user")
    return ingest.customer_messages(conv)


def language_by_turn(turn: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in LANGUAGES]), (turn % len(LANGUAGES)).cast("int"))


def decorated(spark: SparkSession, sf: str) -> DataFrame:
    """All conversation turns, a language by turn, and the decoration of that language."""
    conv = tables.spread(table(spark, sf, "conversations"), "conv_id", "turn")
    conv = conv.withColumn("lang", language_by_turn(F.col("conv_id") + F.col("turn")))
    suffix = F.element_at(lx.literal_map(DECORATION), F.col("lang"))
    return conv.withColumn("text", F.concat("text", suffix))


def split_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.assign_split(table(spark, sf, "embeddings"), "vec_id")


def label_centres(spark: SparkSession, sf: str) -> DataFrame:
    return vx.group_means(table(spark, sf, "embeddings"), "label", "embedding").select("label", "centre")


def nearest_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with split, label and the label of the nearest centre."""
    points = split_vectors(spark, sf)
    packed = vx.as_one_value(label_centres(spark, sf), "label", "centre")
    best = vx.nearest(vx.doubles(F.col("embedding")), F.col("centres"), "label")
    points = points.withColumn("centres", packed)
    return points.withColumn("nearest", best["label"]).select("vec_id", "split", "label", "nearest")


def scratch(spark: SparkSession) -> str:
    """A fresh folder in the session's shared checkpoint folder."""
    return f"{tables.run_folder(spark)}/{uuid.uuid4().hex}"


# Sources, filters, splits


@query
def customer_keywords(spark, sf):
    """Top words and word pairs of customer messages by turn of the conversation."""
    clean = normalise.initial_clean(users(spark, sf))
    clean = clean.withColumn("text_clean", tx.strip_punctuation(F.col("text_clean")))
    return keywords.top_keywords(clean, "turn", "text_clean", 15, lx.stopwords("en"))


def messages(spark, sf) -> DataFrame:
    """Conversation turns with the columns of the raw message table."""
    return table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("tweet_id"),
        F.col("role").alias("author_id"),
        (F.col("role") == "user").alias("inbound"),
        "text",
        F.lit("Tue Oct 31 22:10:47 +0000 2017").alias("created_at"),
        F.when(F.col("turn") > 0, F.col("conv_id") * 1000 + F.col("turn") - 1).alias("in_response_to_tweet_id"),
        (F.col("conv_id") * 1000 + F.col("turn") + 1).cast("string").alias("response_tweet_id"),
    )


@query
def csv_round_trip(spark, sf):
    """Raw message CSV written and read back, line breaks and quotes included."""
    path = scratch(spark)
    tables.write_csv(messages(spark, sf), path)
    return tables.read_messages_csv(spark, path)


@query
def csv_one_file(spark, sf):
    """The same from a single file, which many tasks read once it is larger than a block."""
    path = scratch(spark)
    tables.write_csv(messages(spark, sf).coalesce(1), path)
    return quoted.read_large_csv(spark, path)


@query
def prepared_messages(spark, sf):
    """Customer filter, split, typed time, one row per id, length."""
    out = triage.prepared(messages(spark, sf))
    return out.select(
        "tweet_id",
        "split",
        "text",
        F.unix_seconds("created_at").alias("created_at"),
        "in_response_to_tweet_id",
        "tweet_length",
    )


@query
def stage_by_split(spark, sf):
    """A stage table written by split, one split read back."""
    path = scratch(spark)
    tables.write_table(ingest.assign_split(messages(spark, sf)), path)
    return tables.read_table(spark, path, "validation").select("tweet_id", "author_id", "split")


@query
def vector_round_trip(spark, sf):
    """Vectors saved, checked and loaded: key, size, first and last value."""
    path = scratch(spark)
    tables.save_vectors(table(spark, sf, "embeddings"), path, "vec_id")
    v = tables.load_vectors(spark, path, "vec_id")
    return v.select(
        "vec_id",
        F.size("embedding").cast("bigint").alias("dims"),
        F.round(F.element_at("embedding", 1).cast("double"), 6).alias("first"),
        F.round(F.element_at("embedding", -1).cast("double"), 6).alias("last"),
    )


@query
def csv_quality(spark, sf):
    """Rules over a CSV in which the agents' rows have an unreadable id and some lack a reply id."""
    path = scratch(spark)
    broken = F.when(F.col("inbound"), F.col("tweet_id").cast("string")).otherwise("no id")
    tables.write_csv(messages(spark, sf).withColumn("tweet_id", broken), path)
    rows = tables.cut_lineage(tables.read_messages_csv(spark, path, keep_corrupt=True))
    return monitor.quality_rules(
        rows,
        {
            "readable": F.col("_corrupt_record").isNull(),
            "is_reply": F.col("in_response_to_tweet_id").isNotNull(),
            "has_text": ~tx.is_blank(F.col("text")),
        },
    )


@query
def sample_export(spark, sf):
    """Seeded sample per cluster with its text, exported as CSV and read back."""
    path = scratch(spark)
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    picked = clusters.sample_per_cluster(docs, "source", "doc_id", 100).drop("sample_rank")
    tables.write_csv(picked, path)
    return tables.read_messages_csv(spark, path, picked.schema)


@query
def customer_messages(spark, sf):
    return users(spark, sf).select("conv_id", "turn", "text")


@query
def split_assign(spark, sf):
    return ingest.assign_split(table(spark, sf, "documents"), "doc_id").select("doc_id", "split")


@query
def split_exact(spark, sf):
    return ingest.assign_exact_split(table(spark, sf, "documents"), "doc_id").select("doc_id", "split")


@query
def split_sizes(spark, sf):
    return ingest.split_sizes(ingest.assign_split(table(spark, sf, "documents"), "doc_id"))


@query
def dedup_first_message(spark, sf):
    conv = table(spark, sf, "conversations")
    return prepare.first_per_key(conv, "conv_id", [F.col("turn"), F.col("text")])


@query
def dedup_over_stream(spark, sf):
    """First message of each conversation, from files whose turns are mixed, over two runs of a stream with one checkpoint."""
    path = scratch(spark)
    start = F.lit("2026-01-01 00:00:00").cast("timestamp")
    conv = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    conv = conv.withColumn("created_at", start + F.make_dt_interval(mins=F.col("turn").cast("int")))
    conv.repartition(4, "turn").write.parquet(f"{path}/in")
    for more in (None, conv.limit(1).withColumns({"conv_id": F.lit(-1).cast("long"), "created_at": start + F.make_dt_interval(days=F.lit(30))})):
        if more is not None:  # a later message ends the sessions before it
            more.write.mode("append").parquet(f"{path}/in")
        arriving = incremental.new_messages(spark, f"{path}/in", conv.schema, files_per_batch=1)
        first.write_first_messages(arriving, f"{path}/out", f"{path}/state", key="conv_id").awaitTermination()
    return spark.read.schema(conv.schema).parquet(f"{path}/out").drop("created_at")


@query
def dedup_report(spark, sf):
    return prepare.dedup_report(table(spark, sf, "conversations"), "conv_id")


@query
def dedup_exact_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.md5("text").alias("digest"))
    return prepare.first_per_key(docs, "digest", [F.col("doc_id")])


@query
def parse_timestamps(spark, sf):
    """Event times written in three ways, one of them unreadable, and parsed back."""
    ev = table(spark, sf, "events")
    posted = F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format("ts", "yyyy"))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    written = F.when(F.col("event_type") == "error", F.lit("garbage")).when(
        F.col("event_type") == "click", iso
    ).otherwise(posted)
    return ev.select(
        "event_id", F.unix_seconds(prepare.parse_created_at(written)).alias("created_at")
    )


@query
def text_length(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.length(tx.text_or_empty(F.col("text"))).cast("bigint").alias("tweet_length")
    )


# Text steps


@query
def html_to_text(spark, sf):
    pages = tables.spread(table(spark, sf, "pages"), "page_id")
    s = TextSettings(lowercase=False, strip_urls=False, strip_mentions_hashtags=False)
    return normalise.initial_clean(pages, "html", "text", s).select("page_id", "text")


@query
def strip_urls_mentions_hashtags(spark, sf):
    built = F.concat(
        F.lit("Hola @señor_"), F.col("page_id"), F.lit(" mira "), F.col("url"), F.lit(" ya #año"), F.col("page_id"), F.lit(" www.x.y/z fin")
    )
    pages = table(spark, sf, "pages").select("page_id", built.alias("raw"))
    return normalise.initial_clean(pages, "raw", "text").select("page_id", "text")


@query
def emoticon_expand(spark, sf):
    s = TextSettings(expand_chat_words=False, strip_punctuation=False, lemmatise=False)
    done = normalise.language_steps(decorated(spark, sf), "text", "lang", "out", s)
    return done.select("conv_id", "turn", F.col("out").alias("text"))


@query
def chatword_expand(spark, sf):
    s = TextSettings(convert_emoticons=False, strip_punctuation=False, lemmatise=False)
    spaced = decorated(spark, sf).withColumn("text", tx.collapse_spaces(F.col("text")))
    done = normalise.language_steps(spaced, "text", "lang", "out", s)
    return done.select("conv_id", "turn", F.col("out").alias("text"))


@query
def punctuation_strip(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.strip_punctuation(F.col("text")).alias("text")
    )


@query
def stopword_filter(spark, sf):
    docs = tables.spread(table(spark, sf, "documents"), "doc_id")
    docs = docs.withColumn("text", tx.collapse_spaces(F.lower("text")))
    lists = {code: lx.stopwords(code) for code in LANGUAGES}
    return docs.select("doc_id", tx.drop_words(F.col("text"), F.col("lang"), lists).alias("text"))


@query
def lemma_words(spark, sf):
    docs = tables.spread(table(spark, sf, "documents"), "doc_id")
    docs = docs.withColumn("text", tx.collapse_spaces(tx.strip_punctuation(F.lower("text"))))
    done = tx.lemmatise_words(F.col("text"), F.col("lang"), lx.lemmas().entries)
    return docs.select("doc_id", done.alias("text"))


@query
def normalise_chain(spark, sf):
    done = normalise.normalise(decorated(spark, sf), "text", "lang")
    return done.select("conv_id", "turn", "text_preprocessed")


def clean_documents(spark, sf) -> DataFrame:
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    return docs.withColumn("text", tx.collapse_spaces(tx.strip_punctuation(F.lower("text"))))


@query
def vocabulary(spark, sf):
    return tokenmap.vocabulary(clean_documents(spark, sf), "text", "lang")


@query
def lemma_learn(spark, sf):
    """Lemma of every distinct word that has one: by lexicon, else by ending if the corpus knows the rest."""
    vocab = tables.cut_lineage(tokenmap.vocabulary(clean_documents(spark, sf), "text", "lang"))
    lexicon = spark.createDataFrame(lx.lemmas().rows(), "lang string, form string, lemma string")
    return lemmas.learn_lemmas(vocab, lexicon, spelling.known_words(vocab, 5))


@query
def lemma_paradigms(spark, sf):
    """Rules learned from the documents: endings that stand in for each other on many stems, per language."""
    vocab = tables.cut_lineage(tokenmap.vocabulary(clean_documents(spark, sf), "text", "lang"))
    rules = paradigms.paradigm_rules(spelling.known_words(vocab, 2))
    return rules.withColumn("share", F.round("share", 6))


@query
def lemma_by_paradigm(spark, sf):
    """Lemma of every distinct word that has one: by lexicon, by English ending, or by the rules learned for its language."""
    vocab = tables.cut_lineage(tokenmap.vocabulary(clean_documents(spark, sf), "text", "lang"))
    lexicon = spark.createDataFrame(lx.lemmas().rows(), "lang string, form string, lemma string")
    known = tables.cut_lineage(spelling.known_words(vocab, 2))
    return paradigms.learn_lemmas(vocab, lexicon, known, paradigms.paradigm_rules(known))


@query
def spell_near(spark, sf):
    """Corrections at distance one."""
    vocab = tables.cut_lineage(tokenmap.vocabulary(clean_documents(spark, sf), "text", "lang"))
    return spelling.corrections(vocab, spelling.known_words(vocab, 5), 1)


@query
def spell_correct(spark, sf):
    """Corrections at distance one, else two."""
    vocab = tables.cut_lineage(tokenmap.vocabulary(clean_documents(spark, sf), "text", "lang"))
    return spelling.corrections(vocab, spelling.known_words(vocab, 5), 2)


@query
def spell_by_parts(spark, sf):
    """The same corrections, with those at distance two found by parts of words."""
    vocab = tables.cut_lineage(tokenmap.vocabulary(clean_documents(spark, sf), "text", "lang"))
    return spelling.corrections(vocab, spelling.known_words(vocab, 5), 2, by_parts=True)


@query
def spell_apply(spark, sf):
    docs = clean_documents(spark, sf)
    vocab = tables.cut_lineage(tokenmap.vocabulary(docs, "text", "lang"))
    fixes = tables.cut_lineage(spelling.corrections(vocab, spelling.known_words(vocab, 5)))
    mapping = spelling.as_token_map(vocab, fixes)
    done = tokenmap.apply_token_map(docs, mapping, "doc_id", "text", "lang", "fixed")
    return done.select("doc_id", F.col("fixed").alias("text"))


def detected(spark, sf) -> DataFrame:
    """All documents, with a language model learned from those of the discovery split."""
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    docs = ingest.assign_split(docs, "doc_id")
    model = language.fit_language_table(docs.where("split = 'discovery'"), "text", "lang")
    return language.detect_language(docs, model, "text")


@query
def language_detect(spark, sf):
    return detected(spark, sf).select("doc_id", "detected_language")


@query
def language_confusion(spark, sf):
    """By split: two of the three were not seen in training."""
    return language.confusion(detected(spark, sf), "lang", "detected_language", "split")


# Features and clusters


@query
def tfidf_terms(spark, sf):
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    out = features.idf_table(docs, "doc_id", "text")
    return out.select("term", "df", F.round("idf", 6).alias("idf"))


@query
def hashing_encode(spark, sf):
    docs = clean_documents(spark, sf)
    return features.encode(docs, features.fit_hashing_encoder(docs, "text"), "text").select("doc_id", "embedding")


@query
def word2vec_encode(spark, sf):
    docs = clean_documents(spark, sf)
    encoder = features.fit_word2vec_encoder(docs, "text", FeatureSettings())
    return features.encode(docs, encoder, "text").select("doc_id", "embedding")


def letter_shares():
    """Stand-in for a user's encoder: share of each letter a..z in the text."""
    import numpy as np

    def predict(texts):
        rows = [np.bincount(np.frombuffer(t.encode("ascii", "ignore"), np.uint8), minlength=128)[97:123] for t in texts]
        counts = np.stack(rows).astype("float32")
        return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)

    return predict


@query
def user_encoder(spark, sf):
    shipping.ship(spark)
    docs = tables.spread(table(spark, sf, "documents"), "doc_id")
    docs = docs.select("doc_id", F.lower("text").alias("text"))
    done = features.encode_with(docs, letter_shares, 26, "text")
    return done.select("doc_id", F.posexplode_outer("embedding").alias("position", "v")).select(
        "doc_id", F.col("position").cast("bigint").alias("position"), F.round(F.col("v").cast("double"), 5).alias("share")
    )


def projected(spark, sf, k: int = 50) -> DataFrame:
    points = split_vectors(spark, sf)
    pca = features.fit_pca(points.where("split = 'discovery'"), "embedding", FeatureSettings(pca_components=k))
    return features.reduce_vectors(points, pca)


@query
def pca_project(spark, sf):
    return projected(spark, sf).select("vec_id", "split", "x")


@query
def pca_variance(spark, sf):
    """Share of the variance kept by 8, 16 and all 64 components."""
    points = split_vectors(spark, sf).where("split = 'discovery'")
    fits = [(k, features.fit_pca(points, "embedding", FeatureSettings(pca_components=k))) for k in (8, 16, 64)]
    rows = [(k, round(features.explained_variance(m), 6)) for k, m in fits]
    return spark.createDataFrame(rows, "components int, explained double")


@query
def kmeans_assign(spark, sf):
    points = projected(spark, sf)
    model = clusters.fit_kmeans(points.where("split = 'discovery'"))
    return clusters.assignments(clusters.assign_clusters(points, model), "vec_id")


@query
def nearest_centroid(spark, sf):
    near = clusters.nearest_centre(
        table(spark, sf, "embeddings"), label_centres(spark, sf), "vec_id", "embedding", "label"
    )
    return near.select("vec_id", "nearest", F.round("distance", 6).alias("distance"))


@query
def cluster_sizes(spark, sf):
    return clusters.distribution(table(spark, sf, "embeddings"), "label")


def named(spark, sf) -> DataFrame:
    names = clusters.category_table(spark, CATEGORIES)
    return clusters.label_clusters(table(spark, sf, "embeddings"), names, "label")


@query
def label_clusters(spark, sf):
    return named(spark, sf).select("vec_id", "label", "category")


@query
def category_distribution(spark, sf):
    return clusters.distribution(named(spark, sf), "category")


@query
def unmapped_clusters(spark, sf):
    return clusters.unmapped_clusters(named(spark, sf), "label")


@query
def cluster_keywords(spark, sf):
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    return keywords.top_keywords(docs, "source", "text", 15, lx.stopwords("en"))


@query
def cluster_keywords_by_share(spark, sf):
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id")
    out = keywords.top_keywords_by_document_share(docs, "lang", "text", 20)
    return out.select("lang", "term", "n", "rank")


@query
def cluster_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return clusters.sample_per_cluster(docs, "source", "doc_id", 50).select("source", "doc_id", F.col("sample_rank").cast("bigint").alias("sample_rank"))


@query
def cluster_report(spark, sf):
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    r = reports.cluster_report(
        docs, "source", "doc_id", ("text",), "text", 50, 15, lx.stopwords("en")
    )
    ids = F.transform("samples", lambda x: x["doc_id"].cast("string"))
    return r.select(
        "source",
        "n_rows",
        F.array_join("keywords", "|").alias("keywords"),
        F.array_join(ids, "|").alias("sample_ids"),
        "category_slot",
    )


@query
def cluster_report_text(spark, sf):
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    r = reports.cluster_report(docs, "source", "doc_id", ("text",), "text", 5, 10)
    return reports.report_text(r, "source")


@query
def pseudo_labelled(spark, sf):
    """Vectors with a name for their cluster, joined to the texts they belong to."""
    assigned = named(spark, sf).select(
        F.col("vec_id").alias("tweet_id"), F.col("label").alias("cluster_id"), "category"
    )
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("tweet_id"), "text", F.col("source").alias("author_id"))
    return clusters.pseudo_labelled(clusters.with_text(assigned, texts))


# Cluster validity


@query
def wcss(spark, sf):
    w = validity.within_cluster_sum(table(spark, sf, "embeddings"), "label", "embedding")
    return w.select(F.round("wcss", 5).alias("wcss"))


@query
def calinski_harabasz(spark, sf):
    s = validity.calinski_harabasz(table(spark, sf, "embeddings"), "label", "embedding")
    return s.select(F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@query
def davies_bouldin(spark, sf):
    s = validity.davies_bouldin(table(spark, sf, "embeddings"), "label", "embedding")
    return s.select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query
def silhouette_cosine(spark, sf):
    v = validity.silhouette_cosine(table(spark, sf, "embeddings"), "label", "embedding")
    return spark.createDataFrame([(round(v, 6),)], "silhouette double")


@query
def metric_sample(spark, sf):
    return validity.uniform_sample(table(spark, sf, "embeddings"), "vec_id", 0.5).select("vec_id")


@query
def k_sweep(spark, sf):
    return validity.sweep_k(projected(spark, sf))


# Classifier


@query
def align_features_labels(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("tweet_id"), "embedding")
    lab = table(spark, sf, "labels").select(
        F.col("doc_id").alias("tweet_id"), F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").alias("category")
    )
    both = classify.drop_unlabelled(classify.align(vectors, lab))
    return both.select("tweet_id", "category", F.size("embedding").cast("bigint").alias("dims"))


@query
def missing_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return classify.missing_vectors(vectors, table(spark, sf, "labels"), "doc_id")


@query
def unlabelled_audit(spark, sf):
    audit = classify.unlabelled_audit(named(spark, sf), "vec_id")
    return audit.select("n_unlabelled", F.array_join("first_ids", ",").alias("first_ids"))


@query
def unseen_labels(spark, sf):
    """Labels of the other splits that the category map, as the classes known to training, lacks."""
    rows = split_vectors(spark, sf).where("split <> 'discovery'").select(F.col("label").alias("category"))
    known = clusters.category_table(spark, CATEGORIES).select(F.col("cluster_id").alias("category"))
    return classify.unseen_labels(rows, known)


@query
def class_weights(spark, sf):
    w = classify.class_weights(table(spark, sf, "documents"), "lang")
    return w.select("lang", "n", F.round("weight", 6).alias("weight"))


def clustered_categories(spark, sf) -> DataFrame:
    """Vectors with the name of their fitted cluster as the label to learn."""
    points = tables.cut_lineage(projected(spark, sf).select("vec_id", "split", "x"))
    model = clusters.fit_kmeans(points.where("split = 'discovery'"))
    assigned = clusters.assign_clusters(points, model)
    return clusters.label_clusters(assigned, clusters.category_table(spark, CATEGORIES, 8))


def classified(spark, sf, family: str) -> DataFrame:
    rows = clustered_categories(spark, sf)
    model = classify.fit_classifier(rows.where("split = 'discovery'"), s=ClassifierSettings(family=family))
    return classify.predict(rows, model)


@query
def train_one_against_rest(spark, sf):
    return classified(spark, sf, "ovr").select("vec_id", "split", "category", "predicted_category")


@query
def train_multinomial(spark, sf):
    return classified(spark, sf, "multinomial").select("vec_id", "split", "category", "predicted_category")


@query
def confidence_summary(spark, sf):
    return monitor.confidence_summary(classified(spark, sf, "multinomial"))


@query
def misclassified(spark, sf):
    names = clusters.category_table(spark, CATEGORIES)
    rows = clusters.label_clusters(nearest_labels(spark, sf), names, "label")
    guess = clusters.label_clusters(rows.withColumnRenamed("category", "truth"), names, "nearest")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text", F.lower("text").alias("text_preprocessed"))
    return evaluate.misclassified(clusters.with_text(guess, docs, "vec_id"), "vec_id", "truth", "category")


@query
def classification_report(spark, sf):
    r = evaluate.class_report(nearest_labels(spark, sf), "label", "nearest")
    return r.select("split", "class", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


@query
def accuracy_by_split(spark, sf):
    a = evaluate.accuracy(nearest_labels(spark, sf), "label", "nearest")
    return a.select("split", "n_rows", F.round("accuracy", 6).alias("accuracy"))


# Monitoring


@query
def quality_rules(spark, sf):
    docs = table(spark, sf, "documents")
    return monitor.quality_rules(
        docs,
        {
            "text_not_blank": ~tx.is_blank(F.col("text")),
            "length_matches": F.length("text") == F.col("n_chars"),
            "known_language": F.col("lang").isin("de", "en", "es"),
            "short_enough": F.col("n_chars") <= 5000,
        },
    )


@query
def null_rates(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    r = monitor.null_rates(joined, ["text", "lang", "quality", "toxic"])
    return r.select("column", "n_null", F.round("null_rate", 6).alias("null_rate"))


@query
def vector_statistics(spark, sf):
    s = monitor.vector_statistics(table(spark, sf, "embeddings"), "embedding")
    return s.select(F.col("position").cast("bigint").alias("position"), F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"))


@query
def cluster_spread(spark, sf):
    s = monitor.cluster_spread(table(spark, sf, "embeddings"), "label", "embedding")
    return s.select("label", "n_rows", F.round("variance", 6).alias("variance"))


@query
def train_validation_gap(spark, sf):
    g = monitor.train_validation_gap(nearest_labels(spark, sf), "label", "nearest", "discovery", "validation")
    return g.select("class", *[F.round(c, 6).alias(c) for c in ("f1_train", "f1_other", "gap")])


@query
def drift_psi(spark, sf):
    """Event values of the first half of each hour against the second."""
    ev = table(spark, sf, "events").withColumn("bin", monitor.equal_bins(F.col("value"), 0.0, 50.0, 10))
    early = F.minute("ts") < 30
    out = monitor.stability_index(ev.where(early), ev.where(~early), "bin")
    return out.select("bin", *[F.round(c, 6).alias(c) for c in ("share_old", "share_new", "psi")])


# End to end


def learned(spark, sf):
    """Preprocessed messages of all splits, and everything learned from their discovery split."""
    s = Settings()
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    lang_model = language.fit_language_model(docs)
    raw = tables.spread(messages(spark, sf), "tweet_id")
    texts = tables.cut_lineage(triage.preprocessed(triage.prepared(raw, s), lang_model, s))
    found = triage.discover(texts, s)
    labelled = tables.cut_lineage(triage.pseudo_label(texts, found, CATEGORIES))
    return labelled, triage.train(labelled, found, lang_model)


@query
def triage_messages(spark, sf):
    """Customer messages to categories: every stage learned, saved, loaded, and applied to new messages."""
    _, model = learned(spark, sf)
    path = scratch(spark)
    model.save(path)
    again = triage.Triage.load(spark, path)
    scored = again.score(ingest.customer_messages(messages(spark, sf)))
    return scored.select(
        "tweet_id", "detected_language", "text_preprocessed", "predicted_category", "confidence"
    )


@query
def triage_evaluation(spark, sf):
    """Report of the learned classifier on all three splits."""
    labelled, model = learned(spark, sf)
    return triage.evaluate_all(labelled, model).report


@query
def recluster_recent(spark, sf):
    """Fresh clusters of the messages since a date, with their report. Messages are dated by their conversation,
    from September to November; languages are detected."""
    s = Settings()
    day = F.date_add(F.lit("2017-09-01").cast("date"), (F.floor(F.col("tweet_id") / 1000) % 90).cast("int"))
    raw = tables.spread(messages(spark, sf), "tweet_id").withColumn("created_at", day.cast("string"))
    typed = ingest.customer_messages(raw).withColumn("created_at", prepare.parse_created_at(F.col("created_at")))
    docs = tables.spread(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    texts = tables.cut_lineage(triage.preprocessed(typed, language.fit_language_model(docs), s))
    _, report = triage.recluster(texts, "2017-10-01", s)
    return report.select("cluster_id", "n_rows", "keywords", "category_slot")
