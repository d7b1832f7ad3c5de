"""Batch inference over files as they arrive, with the same steps as the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from postsift.functions import text as tx
from postsift.plans.triage import Triage
from postsift.schema import RAW_MESSAGES
from pyspark.sql import functions as F


def new_messages(spark: SparkSession, path: str, schema: StructType = RAW_MESSAGES, files_per_batch: int = 1000) -> DataFrame:
    """Stream of Parquet message files put under ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_new_files(
    messages: DataFrame, model: Triage, out: str, checkpoint: str
) -> StreamingQuery:
    """Score everything not scored before, append it to ``out`` and stop. The checkpoint holds which
    files are done, so a restarted run neither skips nor repeats one. No state is kept."""
    customers = messages.where(F.col("inbound")).where(~tx.is_blank(F.col("text")))
    scored = model.score(customers)
    keep = [c for c in scored.columns if c not in ("x", "embedding")]
    return (
        scored.select(*keep)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
