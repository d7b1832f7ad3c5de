"""Typing, deduplication and derived columns of the message table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.schema import PREPARED_COLUMNS, project, require_columns


# Whole date and time, with or without fraction and zone; a text without a zone is in the session's time zone.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|UTC|[+-]\d{2}:?\d{2}))?)?$"


def parse_created_at(c: Column) -> Column:
    """``Tue Oct 31 22:10:47 +0000 2017`` or an ISO date or date with time -> timestamp, anything else -> null."""
    c = c.cast("string")
    posted = F.try_to_timestamp(F.regexp_extract(c, r"^[A-Z][a-z]{2} (.+)$", 1), F.lit("MMM dd HH:mm:ss Z yyyy"))
    return F.coalesce(posted, F.when(F.trim(c).rlike(ISO_TIME), F.try_to_timestamp(F.trim(c))))


def first_per_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key. The rank limit is applied within each input partition before
    the shuffle, so a key with very many copies sends one row per partition."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def dedup_messages(df: DataFrame, key: str = "tweet_id") -> DataFrame:
    """First message of each id: earliest time, then text; rows without a time come last."""
    order = [F.col(c).asc_nulls_last() for c in ("created_at", "text") if c in df.columns]
    return first_per_key(require_columns(df, [key], "dedup_messages"), key, order or [F.col(key)])


def dedup_report(df: DataFrame, key: str = "tweet_id") -> DataFrame:
    """``rows_before, rows_after, rows_dropped`` of a deduplication by key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_dropped"),
    )


def prepare_messages(df: DataFrame, columns: Sequence[str] = PREPARED_COLUMNS) -> DataFrame:
    """Typed time, one row per id, text length, wanted columns in order (plus ``split`` if present)."""
    if "created_at" in df.columns:
        df = df.withColumn("created_at", parse_created_at(F.col("created_at")))
    if "tweet_id" in df.columns:
        df = dedup_messages(df)
    if "text" in df.columns:
        text = tx.text_or_empty(F.col("text"))
        df = df.withColumn("text", text).withColumn("tweet_length", F.length(text))
    extra = [c for c in ("split",) if c in df.columns]
    return project(df, [*columns, *extra])
