"""First message of each id over a stream: keyed state that expires.

The batch job keeps the earliest row of an id by a window over all of them. A stream sees copies in different micro-batches, so the best row so far is
kept per id, in a session: copies no more than ``horizon`` apart are copies of one message. When the watermark passes the end of a session, its
row is written and its state is dropped, so state is bounded by what arrived within the horizon, not by all ids there ever were. An id that turns up again
later than that begins a new session.

All of it is Spark's own stateful aggregation: rows are reduced per partition before they are shuffled by id, so an id with very many copies sends
one row per partition, and the state store's checkpoint makes a restarted run go on where the last one ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postsift.schema import require_columns


def first_messages(messages: DataFrame, key: str = "tweet_id", horizon: str = "7 days", lateness: str = "1 day", arrived: Column | None = None) -> DataFrame:
    """The first row of each id of a stream with a timestamp ``created_at``: earliest time, then text; rows without a time come last.

    Rows that arrive more than ``lateness`` behind the latest time seen may be left out. A row without a time takes part at the time ``arrived``, as
    for instance its file's; without that it is left out, as nothing tells when its session ends. Rows without an id are one id. On a batch table
    the result is that of `prepare.dedup_messages` for each session.
    """
    require_columns(messages, [key, "created_at"], "first_messages")
    seen = F.col("created_at") if arrived is None else F.coalesce("created_at", arrived)
    timed = messages.withColumn("_seen", seen.cast("timestamp")).withWatermark("_seen", lateness)
    ranks = [c for c in ("created_at", "text") if c in messages.columns]
    order = [x for c in ranks for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(f"by_{c}"))]
    row = F.struct(*order, F.struct(*[F.col(f"`{c}`") for c in messages.columns]).alias("row"))
    best = timed.groupBy(F.col(key).alias("_id"), F.session_window("_seen", horizon)).agg(F.min(row).alias("best"))
    return best.select("best.row.*")


def write_first_messages(messages: DataFrame, out: str, checkpoint: str, **settings) -> StreamingQuery:
    """Take in everything that is new, append the messages of the sessions that have ended to ``out``, and stop; the others stay in the
    checkpoint's state for the next run."""
    return (
        first_messages(messages, **settings)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
