"""Quality rules, null rates, vector statistics, drift and confidence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.functions import vectors as vx
from postsift.operators import evaluate, validity


def quality_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, n_rows, n_failed)`` for conditions that should hold; all rules in one pass. A null
    condition counts as failed."""
    one = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()],
    )
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("n_failed")) for r in rules])
    return one.select(F.col("_n").alias("n_rows"), F.inline(rows)).select("rule", "n_rows", "n_failed")


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null")) for c in columns])
    return one.select("_n", F.inline(rows)).select(
        "column", "n_null", F.try_divide(F.col("n_null").cast("double"), F.col("_n")).alias("null_rate")
    )


def vector_statistics(df: DataFrame, vector: str) -> DataFrame:
    """``(position, mean, stddev)`` per dimension, one pass, partial sums before the shuffle."""
    moments = Summarizer.metrics("mean", "std").summary(
        array_to_vector(vx.doubles(F.col(vector)))
    )
    one = df.where(F.col(vector).isNotNull()).agg(moments.alias("s"))
    zipped = F.arrays_zip(
        vector_to_array("s.mean").alias("mean"), vector_to_array("s.std").alias("stddev")
    )
    return one.select(F.posexplode(zipped).alias("position", "m")).select("position", "m.mean", "m.stddev")


def cluster_spread(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """``(cluster, n_rows, variance)``: mean squared distance to the centre."""
    return validity.spread_per_cluster(df, cluster, vector).select(
        cluster, F.col("n").alias("n_rows"), (F.col("within") / F.col("n")).alias("variance")
    )


def train_validation_gap(df: DataFrame, truth: str, guess: str, train: str, other: str, split: str = "split") -> DataFrame:
    """Per class and average: F1 on the training split, on the other one, and their difference."""
    report = evaluate.class_report(df.where(F.col(split).isin(train, other)), truth, guess, [split])
    f1 = lambda s: F.max(F.when(F.col(split) == s, F.col("f1")))
    return report.groupBy("class").agg(
        f1(train).alias("f1_train"), f1(other).alias("f1_other"), (f1(train) - f1(other)).alias("gap")
    )


def confidence_summary(df: DataFrame, category: str = "predicted_category", confidence: str = "confidence") -> DataFrame:
    """``(category, n_rows, share, mean_confidence)``."""
    per = df.groupBy(category).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(confidence).alias("mean_confidence"))
    # Over one row per category; the rows are scored once.
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return per.select(category, "n_rows", (F.col("n_rows") / total).alias("share"), "mean_confidence")


def stability_index(
    old: DataFrame, new: DataFrame, bin_: str, floor: float = 1e-6
) -> DataFrame:
    """``(bin, share_old, share_new, psi)``: population stability of a column of bins. The index is the
    sum of ``psi``; empty bins count with ``floor``."""
    both = old.select(F.col(bin_), F.lit(1).alias("o"), F.lit(0).alias("n")).unionByName(
        new.select(F.col(bin_), F.lit(0).alias("o"), F.lit(1).alias("n"))
    )
    per = both.groupBy(bin_).agg(F.sum("o").alias("o"), F.sum("n").alias("n"))
    # Over one row per bin.
    every = Window.partitionBy(F.lit(0))

    def share(c: str) -> Column:
        of_all = F.try_divide(F.col(c).cast("double"), F.sum(c).over(every))
        return F.greatest(F.coalesce(of_all, F.lit(0.0)), F.lit(floor))

    return per.select(bin_, share("o").alias("share_old"), share("n").alias("share_new")).withColumn(
        "psi", (F.col("share_new") - F.col("share_old")) * F.log(F.col("share_new") / F.col("share_old"))
    )


def equal_bins(c: Column, low: float, high: float, bins: int) -> Column:
    """Bin number 0..bins-1 of equal width; values outside go to the end bins."""
    at = F.floor((c - low) / ((high - low) / bins))
    return F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).cast("int")
