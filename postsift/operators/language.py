"""Language identification: character trigrams and a multinomial naive Bayes model.

There are two forms of the same model, with the same answers. `fit_language_model` gives one that scores row by row, without a shuffle or a
join, on streams, too; its counts pass through the driver, and it is bounded. `fit_language_table` keeps the weights as a table: nothing but
one row per language reaches the driver, and any number of trigrams is scored by a join. Whole texts in both.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, IndexToString
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.settings import UNKNOWN_LANGUAGE
from postsift.sources.tables import cut_lineage


def with_trigrams(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_grams", tx.char_trigrams(tx.letters_only(tx.text_or_empty(F.col(text)))))


# Stands for "one text" among the trigrams.
TEXTS = ""


def gram_counts(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """``(lang, gram, n)``, and the number of texts with letters under the empty gram. Counts are
    partial before the shuffle, so common trigrams cost one row per input partition."""
    letters = tx.letters_only(tx.text_or_empty(F.col(text)))
    grams = F.concat(F.array(F.lit(TEXTS)), tx.char_trigrams(F.col("letters")))
    texts = (
        labelled.where(F.col(lang).isNotNull())
        .select(F.col(lang).alias("lang"), letters.alias("letters"))
        .where(F.trim("letters") != "")
    )
    return (
        tx.explode_rows(texts, "lang", gram=grams)
        .groupBy("lang", "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fit_language_model(
    labelled: DataFrame, text: str = "text", lang: str = "lang", max_counts: int = 1 << 23, max_languages: int = 1000
) -> PipelineModel:
    """Learn from texts whose language is known.

    The texts are read once, to count trigrams per language; every trigram enters the model. A language
    enters as one row: its mean counts, weighted by its texts, which gives the sums and priors of
    training on every text. The counts make up the model and reach the driver; more than ``max_counts``
    of them, or ``max_languages`` languages, raise, and nothing is left out: use `fit_language_table` for those.
    """
    counts = cut_lineage(gram_counts(labelled, text, lang))
    per_language = counts.where(F.col("gram") == TEXTS).limit(max_languages + 1).collect()
    if not 1 <= len(per_language) <= max_languages:
        raise ValueError(f"fit_language_model: {len(per_language)} languages, expected 1..{max_languages}")
    found = counts.where(F.col("gram") != TEXTS).limit(max_counts + 1).collect()
    if len(found) > max_counts:
        raise ValueError(f"fit_language_model: more than {max_counts} trigrams by language")
    texts = {r["lang"]: r["n"] for r in per_language}
    names = sorted(texts)
    grams = sorted({r["gram"] for r in found})
    place = {g: i for i, g in enumerate(grams)}
    means: dict[str, dict[int, float]] = {name: {} for name in names}
    for r in found:
        means[r["lang"]][place[r["gram"]]] = r["n"] / texts[r["lang"]]
    rows = [(float(i), float(texts[name]), Vectors.sparse(len(grams), means[name])) for i, name in enumerate(names)]
    spark = labelled.sparkSession
    bayes = NaiveBayes(
        featuresCol="_counts",
        labelCol="_index",
        weightCol="_texts",
        predictionCol="_lang_prediction",
        rawPredictionCol="_lang_raw",
        probabilityCol="_lang_probability",
        smoothing=1.0,
    ).fit(spark.createDataFrame(rows, ["_index", "_texts", "_counts"]))
    counter = CountVectorizerModel.from_vocabulary(grams, inputCol="_grams", outputCol="_counts")
    decode = IndexToString(inputCol="_lang_prediction", outputCol="_lang_name", labels=names)
    return PipelineModel([counter, bayes, decode])


@dataclass
class LanguageTable:
    """``weights``: gram, w: the log weight of a trigram for each of the languages ``names``, in their order. The row of the empty
    gram (`TEXTS`) holds what every text adds once: the logs of the languages' shares of the texts."""

    weights: DataFrame
    names: list[str]

    def save(self, path: str) -> None:
        spark = self.weights.sparkSession
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        spark.createDataFrame(list(enumerate(self.names)), "i int, name string").coalesce(1).write.mode("overwrite").parquet(f"{path}/names")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LanguageTable:
        names = [r.name for r in spark.read.parquet(f"{path}/names").orderBy("i").collect()]
        return cls(spark.read.parquet(f"{path}/weights"), names)


def fit_language_table(labelled: DataFrame, text: str = "text", lang: str = "lang", max_languages: int = 1000) -> LanguageTable:
    """Learn from texts whose language is known, without bringing counts to the driver: one row per language does.

    Every trigram gets one row of weights, for all languages.
    """
    counts = cut_lineage(gram_counts(labelled, text, lang))
    is_text = F.col("gram") == TEXTS
    sums = counts.groupBy("lang").agg(F.sum(F.when(is_text, F.col("n"))).alias("texts"), F.sum(F.when(~is_text, F.col("n"))).alias("grams"))
    found = sorted(sums.limit(max_languages + 1).collect(), key=lambda r: r["lang"])
    if not 1 <= len(found) <= max_languages:
        raise ValueError(f"fit_language_table: {len(found)} languages, expected 1..{max_languages}")
    grams = counts.where(~is_text)
    size = grams.select("gram").distinct().count()
    n_texts = sum(r["texts"] for r in found)
    seen = grams.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n"))
    each = [F.log1p(F.coalesce(F.element_at("n", r["lang"]), F.lit(0))) - F.lit(math.log(r["grams"] + size)) for r in found]
    shares = [math.log(r["texts"] + 1) - math.log(n_texts + len(found)) for r in found]
    once = labelled.sparkSession.createDataFrame([(TEXTS, shares)], "gram string, w array<double>")
    return LanguageTable(cut_lineage(seen.select("gram", F.array(*each).alias("w")).union(once)), [r["lang"] for r in found])


def language_scores(df: DataFrame, model: LanguageTable, letters: str, key: str) -> DataFrame:
    """``key`` and one row of ``scores`` per distinct key, which stands for one text in ``letters``.

    Trigrams meet their weights by a join and are summed per text; sums are partial before they are shuffled by key. Weights that are small
    enough are broadcast by Spark, so that only those sums travel; others are joined by trigram. The most common trigram is one of hundreds in
    each text, so what it adds to one partition is small against the whole, and Spark splits a partition that is too
    large. Rows with the same text add up, and are divided by their number.
    """
    grams = F.concat(F.array(F.lit(TEXTS)), tx.char_trigrams(F.col(letters)))
    texts = df.where(F.trim(letters) != "")
    met = tx.explode_rows(texts, F.col(key).alias("_key"), gram=grams)
    weights = model.weights.select("gram", *[F.get("w", F.lit(i)).alias(f"_w{i}") for i in range(len(model.names))])
    rows = F.count_if(F.col("gram") == TEXTS).alias("_rows")
    sums = [F.sum(f"_w{i}").alias(f"_s{i}") for i in range(len(model.names))]
    done = met.join(weights, "gram").groupBy("_key").agg(rows, *sums)
    return done.select(F.col("_key").alias(key), F.array(*[F.col(f"_s{i}") / F.col("_rows") for i in range(len(sums))]).alias("scores"))


def detect_by_table(df: DataFrame, model: LanguageTable, text: str, out: str) -> DataFrame:
    """Most likely language, of equally likely ones the first by name. Rows meet their scores by a digest of the text's letters, so ids may be
    null or repeated."""
    keyed = df.withColumn("_letters", tx.letters_only(tx.text_or_empty(F.col(text)))).withColumn("_key", F.md5("_letters"))
    scores = language_scores(keyed, model, "_letters", "_key")
    ranked = F.transform("scores", lambda s, i: F.struct(F.round(s, 6).alias("s"), (-i).alias("i")))
    best = -F.array_max(ranked)["i"]
    names = F.array(*[F.lit(n) for n in model.names])
    found = cut_lineage(scores.select(F.col("_key").alias("_digest"), F.get(names, best).alias("_lang_name")))
    joined = keyed.join(found, F.col("_key") == F.col("_digest"), "left")
    return joined.withColumn(out, F.coalesce("_lang_name", F.lit(UNKNOWN_LANGUAGE))).drop("_letters", "_key", "_digest", "_lang_name")


def detect_language(
    df: DataFrame, model: PipelineModel | LanguageTable, text: str = "text_clean", out: str = "detected_language"
) -> DataFrame:
    """Most likely language; texts without a letter are ``unknown``. A `LanguageTable` is joined, which a stream cannot do."""
    if isinstance(model, LanguageTable):
        return detect_by_table(df, model, text, out)
    scored = model.transform(with_trigrams(df, text))
    name = F.when(F.size("_grams") > 0, F.col("_lang_name")).otherwise(F.lit(UNKNOWN_LANGUAGE))
    return scored.withColumn(out, name).drop(
        "_grams", "_counts", "_lang_raw", "_lang_probability", "_lang_prediction", "_lang_name"
    )


def confusion(df: DataFrame, truth: str, guess: str, *by: str) -> DataFrame:
    return df.groupBy(*by, truth, guess).agg(F.count(F.lit(1)).alias("n"))
