"""Token counts from an exact histogram of encoded lengths.

Texts are encoded once; what is kept is how many documents have each length. Suffix sums over the lengths answer, for any
context limit, how many documents and tokens exceed it, how many tokens are left when each document is truncated to
it, and which share of documents fits: the quantiles. All are exact, as every document is counted.

The histogram has one row per distinct length. The sums run within ranges of lengths in parallel, and over the totals of the
ranges, of which there are as many as the longest text has thousands of tokens.

Defined results: null or empty text has length 0 and is counted. Null lengths are left out. An empty table gives empty tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from postsift.llm.bpe import add_column, vocabulary

#: Lengths in a range.
RANGE = 1024


def count_tokens(df: DataFrame, path: str, text: str = "text", length: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of each text."""

    def work(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([len(x) for x in vocabulary(path).encode([t or "" for t in texts.to_pylist()])], np.int64))

    return add_column(df, length, LongType(), work, text)


def histogram(df: DataFrame, length: str = "n_tokens") -> DataFrame:
    """length, n_docs."""
    lengths = df.select(F.col(f"`{length}`").cast("long").alias("length")).where("length is not null")
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def limits(counts: DataFrame) -> DataFrame:
    """For each length as a context limit: documents and tokens at or above it, and what truncation leaves.

    length, n_docs; docs_over, tokens_over: longer documents and their tokens; truncated_tokens: all tokens when each document
    is cut to the limit; docs_within: share of documents that fit.
    """
    rows = counts.withColumns({"range": F.floor(F.col("length") / RANGE), "tokens": F.col("length") * F.col("n_docs")})
    totals = rows.groupBy("range").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("tokens"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "range",
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("docs", "tokens")],
        *[F.sum(c).over(every).alias(f"{c}_all") for c in ("docs", "tokens")],
    )
    within = Window.partitionBy("range").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(totals, "range").select(
        "length",
        "n_docs",
        (F.col("docs_above") + F.coalesce(F.sum("n_docs").over(within), F.lit(0))).alias("docs_over"),
        (F.col("tokens_above") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).alias("tokens_over"),
        "docs_all",
        "tokens_all",
    )
    cut = F.col("tokens_all") - F.col("tokens_over") + F.col("length") * F.col("docs_over")
    fits = F.lit(1.0) - F.col("docs_over") / F.col("docs_all")
    return rows.select("length", "n_docs", "docs_over", "tokens_over", cut.alias("truncated_tokens"), fits.alias("docs_within"))


def quantiles(limits_: DataFrame, shares: list[float]) -> DataFrame:
    """share, length: the smallest limit within which at least that share of the documents fits."""
    picks = [F.min(F.when(F.col("docs_within") >= F.lit(s), F.col("length"))).alias(f"q{i}") for i, s in enumerate(shares)]
    pairs = [F.struct(F.lit(s).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares)]
    return limits_.agg(*picks).select(F.inline(F.array(*pairs)))


def truncated_to(limits_: DataFrame, limit: int) -> DataFrame:
    """One row: documents over any limit, and all tokens when cut to it, also where no document has just that length."""
    over = F.col("length") > limit
    n, tokens = F.sum(F.when(over, F.col("n_docs"))), F.sum(F.when(over, F.col("length") * F.col("n_docs")))
    total = F.sum(F.col("length") * F.col("n_docs"))
    zero = F.lit(0)
    return limits_.agg(
        F.coalesce(n, zero).alias("docs_over"),
        (F.coalesce(total, zero) - F.coalesce(tokens, zero) + F.lit(limit) * F.coalesce(n, zero)).alias("truncated_tokens"),
    )
