"""Arithmetic on ``array<double>`` columns and centre tables of a checked size."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(c: Column) -> Column:
    return c.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )


def unit(a: Column) -> Column:
    length = F.sqrt(dot(a, a))
    return F.transform(a, lambda x: x / length)


def group_means(df: DataFrame, group: str, vector: str) -> DataFrame:
    """One row per group: ``(group, n, centre)``. Sums are partial before the shuffle, so a group that
    holds a third of the rows costs one small row per input partition."""
    return (
        df.select(group, array_to_vector(doubles(F.col(vector))).alias("v"))
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("v")).alias("m"))
        .select(group, "n", vector_to_array("m").alias("centre"))
    )


def as_one_value(table: DataFrame, *columns: str, max_rows: int = 10_000) -> Column:
    """A small table as one array of structs, sorted by its first column, for use inside expressions.

    For one row per cluster or class. A table of more than ``max_rows`` rows raises at run time; no more than
    that are ever collected.
    """
    packed = F.when(
        F.count(F.lit(1)) <= max_rows, F.array_sort(F.collect_list(F.struct(*columns)))
    ).otherwise(F.raise_error(F.lit(f"more than {max_rows} rows of {columns}")))
    return table.limit(max_rows + 1).agg(packed.alias("packed")).scalar()


def as_one_map(table: DataFrame, key: str, value: str, max_rows: int = 10_000) -> Column:
    """`as_one_value` as a map, built once for the query. Rows with a null key are left out."""
    rows = table.where(F.col(key).isNotNull()).limit(max_rows + 1)
    packed = F.when(
        F.count(F.lit(1)) <= max_rows, F.map_from_entries(F.collect_list(F.struct(key, value)))
    ).otherwise(F.raise_error(F.lit(f"more than {max_rows} rows of {key}")))
    return rows.agg(packed.alias("packed")).scalar()


def nearest(vector: Column, centres: Column, key: str) -> Column:
    """``struct(distance, key)`` of the closest centre; ties go to the smallest key."""
    return F.array_min(
        F.transform(
            centres,
            lambda c: F.struct(
                F.sqrt(squared_distance(vector, c["centre"])).alias("distance"), c[key].alias(key)
            ),
        )
    )
