"""Customer filter, blank filter and reproducible split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.schema import require_columns
from postsift.settings import SPLITS, IngestSettings


class TooFewRows(ValueError):
    """Not enough rows to split."""


def customer_messages(raw: DataFrame, inbound: str = "inbound", text: str = "text") -> DataFrame:
    """Inbound rows with text in them. Null ``inbound`` is not inbound; null text is empty."""
    require_columns(raw, [inbound, text], "customer_messages")
    return (
        raw.where(F.col(inbound)).withColumn(text, tx.text_or_empty(F.col(text))).where(~tx.is_blank(F.col(text)))
    )


def split_column(key: Column, s: IngestSettings = IngestSettings()) -> Column:
    bucket = tx.stable_bucket(key, s.seed)
    first = round(s.discovery_share * 10_000)
    second = first + round(s.validation_share * 10_000)
    return (
        F.when(bucket < first, SPLITS[0]).when(bucket < second, SPLITS[1]).otherwise(F.lit(SPLITS[2]))
    )


def assign_split(df: DataFrame, key: str = "tweet_id", s: IngestSettings = IngestSettings()) -> DataFrame:
    """Split by hash of the key: no shuffle, no leak of a key's copies, same result on every run.
    Shares are met in expectation."""
    require_columns(df, [key], "assign_split")
    return df.withColumn("split", split_column(F.col(key), s))


def _key_hash(key: Column, seed: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def assign_exact_split(
    df: DataFrame, key: str = "tweet_id", s: IngestSettings = IngestSettings()
) -> DataFrame:
    """Split with exact sizes for unique keys.

    Rows are ranked by the 60-bit hash of their key. The hashes at the two borders are found by counting
    rows per hash prefix, twelve bits at a time: five aggregations of at most 8192 rows each, no sort.
    """
    require_columns(df, [key], "assign_exact_split")
    hashed = df.select(_key_hash(F.col(key), s.seed).alias("h"))
    ranks: list[int] = []
    # Per border: smallest hash it can be, and the rows below that.
    low, below = [0, 0], [0, 0]
    for shift in (48, 36, 24, 12, 0):
        width = 1 << (shift + 12)
        near = [(F.col("h") >= at) & (F.col("h") < at + width) for at in low]
        counts = (
            hashed.where(near[0] | near[1])
            .groupBy(F.shiftright("h", shift).alias("prefix"))
            .count()
            .collect()
        )
        if not ranks:
            total = sum(n for _, n in counts)
            if total < s.min_rows:
                raise TooFewRows(f"{total} rows, need {s.min_rows}")
            first = int(total * s.discovery_share)
            relative = s.validation_share / (1 - s.discovery_share)
            ranks = [first, first + int((total - first) * relative)]
        for i, rank in enumerate(ranks):
            start, end = low[i], low[i] + width
            for prefix, n in sorted(counts):
                at = prefix << shift
                if not start <= at < end:
                    continue
                low[i] = at
                if below[i] + n > rank:
                    break
                below[i] += n
            else:
                low[i] = end
    h = _key_hash(F.col(key), s.seed)
    return df.withColumn(
        "split",
        F.when(h < low[0], SPLITS[0]).when(h < low[1], SPLITS[1]).otherwise(F.lit(SPLITS[2])),
    )


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and percentage per split from a single pass; a split without rows is listed with 0."""
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(split) == name).alias(name) for name in SPLITS],
    )
    rows = F.array(*[F.struct(F.lit(n).alias("split"), F.col(n).alias("n_rows")) for n in SPLITS])
    return one.select("total", F.explode(rows).alias("r")).select(
        "r.split",
        "r.n_rows",
        F.round(F.try_divide(100.0 * F.col("r.n_rows"), F.col("total")), 6).alias("pct"),
    )


def check_split_sizes(df: DataFrame, s: IngestSettings = IngestSettings()) -> dict[str, int]:
    """Sizes per split; raises when there is nothing to learn from."""
    sizes = {r.split: r.n_rows for r in split_sizes(df).collect()}
    if sum(sizes.values()) < s.min_rows:
        raise TooFewRows(f"{sizes}: fewer than {s.min_rows} rows")
    if sizes[SPLITS[0]] == 0:
        raise TooFewRows(f"{sizes}: no {SPLITS[0]} rows")
    return sizes
