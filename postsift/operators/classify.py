"""Training and scoring of the category classifier."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.schema import require_columns
from postsift.settings import ClassifierSettings


class NoTrainingData(ValueError):
    """No row with both a vector and a label."""


def align(vectors: DataFrame, labelled: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Rows that have both a vector and an entry in the labelled table, joined on the key."""
    require_columns(vectors, [key], "align")
    require_columns(labelled, [key, "category"], "align")
    return vectors.join(labelled.drop(*[c for c in vectors.columns if c != key]), key, "inner")


def missing_vectors(vectors: DataFrame, labelled: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Labelled rows without a vector."""
    return labelled.join(vectors.select(key), key, "left_anti").select(key)


def drop_unlabelled(df: DataFrame, label: str = "category") -> DataFrame:
    return df.where(F.col(label).isNotNull())


def unlabelled_audit(df: DataFrame, key: str = "tweet_id", label: str = "category", n_ids: int = 5) -> DataFrame:
    """How many rows lack a label and the smallest ids among them."""
    bad = df.where(F.col(label).isNull())
    first = bad.orderBy(key).limit(n_ids).agg(F.array_sort(F.collect_list(key)).alias("a"))
    return bad.agg(F.count(F.lit(1)).alias("n_unlabelled")).select(
        "n_unlabelled", first.scalar().alias("first_ids")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight = rows / (classes * rows of the class)."""
    per_class = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # Over one row per class.
    every = Window.partitionBy(F.lit(0))
    weight = F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    return per_class.select(label, "n", weight.alias("weight"))


def unseen_labels(df: DataFrame, known: DataFrame, label: str = "category") -> DataFrame:
    """Labels of ``df`` that training did not have, with their rows."""
    rows = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.join(known.select(label).distinct(), label, "left_anti")


def _features(x: str) -> Column:
    """Vector with a constant 1 at its end, so that the intercept is a weight like the others."""
    return array_to_vector(F.concat(F.col(x).cast("array<double>"), F.array(F.lit(1.0))))


def fit_classifier(
    df: DataFrame, label: str = "category", x: str = "x", s: ClassifierSettings = ClassifierSettings()
) -> PipelineModel:
    """Logistic regression and label decoding as one saved model, for `predict`.

    ``ovr``: one two-class problem per class, each minimising |w|^2 / 2 + C * sum(weight * log loss) with
    the intercept penalised and the class weight on the class's own rows only; two classes are one such
    problem with both weights. ``multinomial``: one softmax model with class weights on all rows and a
    free intercept.
    """
    rows = drop_unlabelled(df.select(label, x), label)
    index = StringIndexer(
        inputCol=label, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="error"
    )
    try:
        index = index.fit(rows)
    except Exception as e:  # an empty table has no labels to index
        raise NoTrainingData("fit_classifier: no labelled rows") from e
    if len(index.labels) < 2:
        raise NoTrainingData(f"fit_classifier: {len(index.labels)} classes, need two")
    counts = {r[label]: r["n"] for r in class_weights(rows, label).collect()}
    total, classes = sum(counts.values()), len(index.labels)
    weights = [total / (classes * counts[c]) if s.balanced else 1.0 for c in index.labels]
    weight_of = F.get(F.array(*[F.lit(w) for w in weights]), F.col("_label").cast("int"))

    data = index.transform(rows).select("_label", _features(x).alias("_features")).persist()
    try:
        if s.family == "ovr" and classes > 2:
            models = _one_against_rest(data, weights, [counts[c] for c in index.labels], s)
        else:
            data_weighted = data.withColumn("_weight", weight_of)
            weighted = sum(w * counts[c] for w, c in zip(weights, index.labels))
            one = _logistic(s, 1.0 / (s.c * weighted), "multinomial" if classes > 2 else "binomial")
            if s.family == "ovr":
                models = [one.fit(_half_mirrored(data_weighted))]
            else:
                models = [one.setFitIntercept(True).fit(data_weighted)]
    finally:
        data.unpersist()
    decode = IndexToString(inputCol="_prediction", outputCol="predicted_category", labels=index.labels)
    return PipelineModel([*models, decode])


def _half_mirrored(two: DataFrame) -> DataFrame:
    """The same two-class problem with about half of its rows mirrored: (x, y) -> (-x, 1 - y).

    Log loss of a linear score without an intercept is the same for a row and its mirror image, so the
    optimum does not move. The feature that stands for the intercept is no longer constant, though, and
    MLlib leaves constant features out.
    """
    x = vector_to_array("_features")
    mirror = F.pmod(F.xxhash64(x), F.lit(2)) == 1
    return two.select(
        F.when(mirror, array_to_vector(F.transform(x, lambda v: -v))).otherwise(F.col("_features")).alias("_features"),
        F.when(mirror, 1.0 - F.col("_label")).otherwise(F.col("_label")).alias("_label"),
        "_weight",
    )


def _logistic(s: ClassifierSettings, reg: float, family: str, **cols) -> LogisticRegression:
    cols = {"predictionCol": "_prediction", "rawPredictionCol": "_raw", "probabilityCol": "_probability"} | cols
    return LogisticRegression(
        featuresCol="_features",
        labelCol="_label",
        weightCol="_weight",
        fitIntercept=False,
        standardization=False,
        regParam=reg,
        maxIter=s.max_iter,
        tol=1e-8,
        family=family,
        **cols,
    )


def _one_against_rest(
    data: DataFrame, weights: list[float], counts: list[int], s: ClassifierSettings
) -> list[LogisticRegressionModel]:
    """One two-class model per class. Each only adds its margin, in a column of its own, so that they are
    applied one after the other to a row, on batches and streams alike."""
    total = sum(counts)

    def fit(c: int) -> LogisticRegressionModel:
        w, n = weights[c], counts[c]
        mine = F.col("_label") == c
        two = data.select(
            "_features",
            mine.cast("double").alias("_label"),
            F.when(mine, F.lit(w)).otherwise(F.lit(1.0)).alias("_weight"),
        )
        reg = 1.0 / (s.c * (w * n + total - n))
        model = _logistic(s, reg, "binomial", rawPredictionCol=f"_margin_{c}").fit(_half_mirrored(two))
        return model.setPredictionCol("").setProbabilityCol("")

    # The problems are independent and each leaves gaps between its iterations.
    with ThreadPool(min(s.parallelism, len(weights))) as pool:
        return pool.map(inheritable_thread_target(data.sparkSession)(fit), range(len(weights)))


def predict(df: DataFrame, model: PipelineModel, x: str = "x") -> DataFrame:
    """Adds ``predicted_category`` and ``confidence``: the softmax probability, or for one-against-rest
    the winning probability after the classes' own are made to add up to one. Row-local."""
    *models, decode = model.stages
    scored = df.withColumn("_features", _features(x))
    for m in models:
        scored = m.transform(scored)
    margins = [m.getRawPredictionCol() for m in models]
    if len(models) == 1:
        share = F.array_max(vector_to_array("_probability"))
        margins = ["_raw", "_probability"]
    else:
        scored = scored.withColumn("_all", F.array(*[F.get(vector_to_array(m), F.lit(1)) for m in margins]))
        # The first of the largest margins.
        best = F.array_position("_all", F.array_max("_all")) - 1
        scored = scored.withColumn("_prediction", best.cast("double"))
        each = F.transform("_all", lambda z: 1.0 / (1.0 + F.exp(-z)))
        share = F.array_max(each) / F.aggregate(each, F.lit(0.0), lambda a, p: a + p)
    scored = decode.transform(scored.withColumn("confidence", share))
    return scored.drop("_features", "_prediction", "_all", *margins)


def known_labels(model: PipelineModel) -> list[str]:
    return list(model.stages[-1].getLabels())
