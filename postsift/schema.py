"""Column types of the raw message table and the column checks every stage uses."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_MESSAGES = T.StructType(
    [
        T.StructField("tweet_id", T.LongType()),
        T.StructField("author_id", T.StringType()),
        T.StructField("inbound", T.BooleanType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("in_response_to_tweet_id", T.LongType()),
        T.StructField("response_tweet_id", T.StringType()),
    ]
)
RAW_COLUMNS = tuple(RAW_MESSAGES.fieldNames())
PREPARED_COLUMNS = RAW_COLUMNS + ("tweet_length",)

CATEGORY_MAP = T.StructType(
    [T.StructField("cluster_id", T.IntegerType()), T.StructField("category", T.StringType())]
)


class MissingColumns(ValueError):
    """A stage was given a table without a column it cannot do without."""


def require_columns(df: DataFrame, wanted: Sequence[str], stage: str) -> DataFrame:
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise MissingColumns(f"{stage}: missing {missing}, table has {df.columns}")
    return df


def project(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Select ``wanted`` in order; absent ones are left out with a warning, none at all is an error."""
    present = [c for c in wanted if c in df.columns]
    if not present:
        raise MissingColumns(f"none of {list(wanted)} in {df.columns}")
    if len(present) < len(wanted):
        warnings.warn(f"columns left out: {[c for c in wanted if c not in present]}", stacklevel=2)
    return df.select(*present)
