"""Accuracy, per-class report and errors, for all splits in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(a: Column, b: Column) -> Column:
    """Quotient, 0 where the divisor is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def accuracy(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ("split",)) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg((F.col(truth) == F.col(guess)).cast("double")).alias("accuracy"),
    )


def class_report(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ("split",)) -> DataFrame:
    """``(by.., class, precision, recall, f1, support)`` per class, then ``accuracy``, ``macro avg`` and
    ``weighted avg``. Everything after the first count works on classes squared rows at most."""
    cells = df.groupBy(*by, F.col(truth).alias("_t"), F.col(guess).alias("_g")).agg(
        F.count(F.lit(1)).alias("n")
    )
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("_t") == F.col("_g"), F.col("n")).otherwise(zero)

    def part(name: str, support: Column, predicted: Column, right: Column) -> Column:
        return F.struct(
            F.col(name).cast("string").alias("class"),
            support.alias("support"),
            predicted.alias("predicted"),
            right.alias("right"),
        )

    both = F.array(part("_t", F.col("n"), zero, hit), part("_g", zero, F.col("n"), zero))
    per_class = (
        cells.select(*by, F.inline(both))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("right").alias("right"))
        .withColumn("precision", _share(F.col("right"), F.col("predicted")))
        .withColumn("recall", _share(F.col("right"), F.col("support")))
        .withColumn(
            "f1", _share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        )
    )
    measures = ("precision", "recall", "f1")
    rows = F.sum("support")
    summary = per_class.groupBy(*by).agg(
        rows.alias("support"),
        (F.sum("right") / rows).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / rows).alias(f"weighted_{m}") for m in measures],
    )
    overall = F.array(
        F.struct(F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(m) for m in measures]),
        F.struct(F.lit("macro avg").alias("class"), *[F.col(f"macro_{m}").alias(m) for m in measures]),
        F.struct(F.lit("weighted avg").alias("class"), *[F.col(f"weighted_{m}").alias(m) for m in measures]),
    )
    averages = summary.select(*by, "support", F.inline(overall))
    columns = [*by, "class", *measures, "support"]
    return per_class.select(*columns).unionByName(averages.select(*columns))


def report_text(report: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """The report as one text per split; classes first, averages last."""
    averages = ["accuracy", "macro avg", "weighted avg"]
    line = F.format_string(
        "%28s %9.2f %9.2f %9.2f %9d", "class", "precision", "recall", "f1", "support"
    )
    order = F.struct(F.col("class").isin(*averages).alias("last"), F.col("class"), line.alias("line"))
    head = F.lit("%28s %9s %9s %9s %9s" % ("", "precision", "recall", "f1", "support"))
    return report.groupBy(*by).agg(F.array_sort(F.collect_list(order)).alias("r")).select(
        *by, F.concat_ws("\n", head, F.array_join(F.transform("r", lambda x: x["line"]), "\n")).alias("report")
    )


def misclassified(
    df: DataFrame, key: str = "tweet_id", truth: str = "category", guess: str = "predicted_category",
    text: str = "text", clean: str = "text_preprocessed",
) -> DataFrame:
    keep = [c for c in ("split",) if c in df.columns]
    return df.where(F.col(truth) != F.col(guess)).select(
        key,
        *keep,
        F.col(text).alias("original_text"),
        F.col(clean).alias("preprocessed_text"),
        F.col(truth).alias("true_category"),
        F.col(guess).alias("predicted_category"),
    )


def evaluable(df: DataFrame, known: Sequence[str], truth: str = "category", split: str = "split") -> tuple[DataFrame, DataFrame]:
    """Rows of splits whose labels training all knew, and a table of the others' unknown labels."""
    unknown = (
        df.where(F.col(truth).isNotNull() & ~F.col(truth).isin(*known))
        .groupBy(split, truth)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    # At most one row per split.
    skipped = [r[0] for r in unknown.select(split).distinct().collect()]
    kept = df.where(F.col(truth).isNotNull())
    return (kept.where(~F.col(split).isin(*skipped)) if skipped else kept), unknown
