"""The whole job: learn categories from unlabelled messages, then score new ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.functions import lexicons as lx
from postsift.operators import (
    classify,
    clusters,
    evaluate,
    features,
    ingest,
    language,
    normalise,
    prepare,
    reports,
    spelling,
)
from postsift.schema import CATEGORY_MAP
from postsift.settings import SPLITS, Settings, settings_from_json, settings_json
from postsift.sources import tables

DISCOVERY = SPLITS[0]


def prepared(raw: DataFrame, s: Settings = Settings(), exact_split: bool = False) -> DataFrame:
    """Raw messages -> customer messages, split, typed, one row per id. One shuffle, by id."""
    customers = ingest.customer_messages(raw)
    split = ingest.assign_exact_split if exact_split else ingest.assign_split
    return prepare.prepare_messages(split(customers, "tweet_id", s.ingest))


def preprocessed(
    messages: DataFrame,
    language_model: PipelineModel | language.LanguageTable | None = None,
    s: Settings = Settings(),
    dictionary: DataFrame | None = None,
    **lexica: lx.Lexicon,
) -> DataFrame:
    """Adds ``detected_language`` and ``text_preprocessed``. Without a model the table must bring its
    ``detected_language``."""
    clean = normalise.initial_clean(messages, "text", "text_clean", s.text)
    if language_model is not None:
        clean = language.detect_language(clean, language_model, "text_clean", "detected_language")
    if not s.text.correct_spelling:
        return normalise.language_steps(clean, s=s.text, **lexica).drop("text_clean")
    # Spelling looks at words without punctuation and stopwords and comes before lemmas.
    from dataclasses import replace

    first = replace(s.text, lemmatise=False)
    last = replace(
        s.text,
        convert_emoticons=False,
        expand_chat_words=False,
        strip_punctuation=False,
        remove_stopwords=False,
    )
    words = normalise.language_steps(clean, s=first, **lexica).drop("text_clean")
    fixed = spelling.correct_spelling(
        words, "tweet_id", "text_preprocessed", "detected_language", "_fixed", dictionary
    )
    done = normalise.language_steps(fixed.drop("text_preprocessed"), "_fixed", s=last, **lexica)
    return done.drop("_fixed")


@dataclass
class Discovery:
    """Models fitted on the discovery split, to be looked at and named before training."""

    encoder: PipelineModel | None
    pca: PipelineModel
    kmeans: KMeansModel
    settings: Settings

    def vectors(self, df: DataFrame) -> DataFrame:
        if self.encoder is not None:
            df = features.encode(df, self.encoder)
        return features.reduce_vectors(df, self.pca)

    def clustered(self, df: DataFrame) -> DataFrame:
        return clusters.assign_clusters(self.vectors(df), self.kmeans)

    def report(self, df: DataFrame) -> DataFrame:
        """Cluster report of the discovery rows of ``df``, without category names."""
        s = self.settings
        stop = () if s.text.remove_stopwords else lx.stopwords("en")
        return reports.cluster_report(
            self.clustered(df.where(F.col("split") == DISCOVERY)),
            n_samples=s.clusters.report_samples,
            n_keywords=s.clusters.report_keywords,
            stop=stop,
            seed=s.clusters.seed,
        )


def discover(
    texts: DataFrame,
    s: Settings = Settings(),
    fit_encoder: Callable[..., PipelineModel] | None = features.fit_hashing_encoder,
    k: int | None = None,
) -> Discovery:
    """Fit encoder, PCA and KMeans on the discovery split. With ``fit_encoder=None`` the table brings
    its own ``embedding`` column."""
    found = texts.where(F.col("split") == DISCOVERY)
    encoder = None
    if fit_encoder is not None:
        encoder = fit_encoder(found, "text_preprocessed", s.features)
        found = features.encode(found, encoder)
    found = tables.cut_lineage(found.select("embedding"))
    if (rows := found.count()) < s.ingest.min_rows:
        raise ingest.TooFewRows(f"{rows} {DISCOVERY} rows, need {s.ingest.min_rows}")
    pca = features.fit_pca(found, "embedding", s.features)
    kmeans = clusters.fit_kmeans(features.reduce_vectors(found, pca).select("x"), "x", k, s.clusters)
    return Discovery(encoder, pca, kmeans, s)


def pseudo_label(texts: DataFrame, found: Discovery, names: Mapping[int, str] | DataFrame) -> DataFrame:
    """All splits with vector, cluster and category."""
    k = len(found.kmeans.clusterCenters())
    categories = clusters.category_table(texts.sparkSession, names, k)
    return clusters.label_clusters(found.clustered(texts), categories, max_clusters=found.settings.clusters.max_clusters)


@dataclass
class Triage:
    """Everything needed to score a message."""

    discovery: Discovery
    classifier: PipelineModel
    language_model: PipelineModel | language.LanguageTable | None = None
    categories: dict[int, str] | None = None

    def score(self, messages: DataFrame, **lexica: lx.Lexicon) -> DataFrame:
        """New messages -> ``predicted_category`` and ``confidence``. Row-local unless spelling correction
        is on or the language model is a table: no shuffle, so it also runs on a stream."""
        texts = preprocessed(messages, self.language_model, self.discovery.settings, **lexica)
        return self.score_texts(texts)

    def score_texts(self, texts: DataFrame) -> DataFrame:
        return classify.predict(self.discovery.vectors(texts), self.classifier)

    def save(self, path: str) -> None:
        """All models, the settings they were fitted with, and the names of the clusters."""
        d = self.discovery
        parts = {"pca": d.pca, "kmeans": d.kmeans, "classifier": self.classifier}
        parts |= {"encoder": d.encoder} if d.encoder is not None else {}
        by_table = isinstance(self.language_model, language.LanguageTable)
        parts |= {"language": self.language_model} if self.language_model is not None and not by_table else {}
        if by_table:
            self.language_model.save(f"{path}/language_table")
        for name, model in parts.items():
            model.write().overwrite().save(f"{path}/{name}")
        spark = SparkSession.active()
        rows = {"parts": ([(n,) for n in sorted([*parts, *["language_table"] * by_table])], "part string"), "settings": ([(settings_json(d.settings),)], "settings string")}
        rows["categories"] = (sorted((self.categories or {}).items()), CATEGORY_MAP)
        for name, (table, schema) in rows.items():
            spark.createDataFrame(table, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Triage:
        """What `save` wrote; raises if the names do not fit the clusters."""
        s = settings_from_json(spark.read.parquet(f"{path}/settings").first().settings)
        have = {r.part for r in spark.read.parquet(f"{path}/parts").collect()}
        pipe = lambda name: PipelineModel.load(f"{path}/{name}") if name in have else None
        found = Discovery(pipe("encoder"), pipe("pca"), KMeansModel.load(f"{path}/kmeans"), s)
        categories = {r.cluster_id: r.category for r in spark.read.parquet(f"{path}/categories").collect()}
        k = len(found.kmeans.clusterCenters())
        if wrong := [c for c in categories if not 0 <= c < k]:
            raise ValueError(f"names for clusters {wrong}, but the model has {k}")
        languages = language.LanguageTable.load(spark, f"{path}/language_table") if "language_table" in have else pipe("language")
        return cls(found, pipe("classifier"), languages, categories or None)


def train(labelled: DataFrame, found: Discovery, language_model: PipelineModel | language.LanguageTable | None = None) -> Triage:
    """Fit the classifier on the discovery rows of a pseudo-labelled table."""
    rows = labelled.where(F.col("split") == DISCOVERY)
    model = classify.fit_classifier(rows, "category", "x", found.settings.classifier)
    names = None
    if "cluster_id" in rows.columns:
        limit = found.settings.clusters.max_clusters
        pairs = rows.select("cluster_id", "category").distinct().where("category is not null").limit(limit + 1).collect()
        if len(pairs) > limit:
            raise ValueError(f"train: more than {limit} clusters with names")
        names = {r.cluster_id: r.category for r in pairs}
    return Triage(found, model, language_model, names)


@dataclass
class Evaluation:
    accuracy: DataFrame
    report: DataFrame
    errors: DataFrame
    unseen: DataFrame


def evaluate_all(labelled: DataFrame, model: Triage) -> Evaluation:
    """Accuracy, report and errors of every split. Splits with labels unknown to training are left out and
    their labels listed."""
    kept, unseen = evaluate.evaluable(labelled, classify.known_labels(model.classifier))
    scored = classify.predict(kept, model.classifier)
    return Evaluation(
        evaluate.accuracy(scored, "category", "predicted_category"),
        evaluate.class_report(scored, "category", "predicted_category"),
        evaluate.misclassified(scored),
        unseen,
    )


def recluster(texts: DataFrame, since: str, s: Settings = Settings(), k: int | None = None, **kw) -> tuple[Discovery, DataFrame]:
    """Fit new clusters on messages since a date and report them, to look for new categories."""
    recent = texts.where(F.col("created_at") >= F.to_timestamp(F.lit(since))).withColumn("split", F.lit(DISCOVERY))
    found = discover(recent, s, k=k, **kw)
    return found, found.report(recent)
