"""From raw documents to packed training sequences: four stages, each over all that the one before kept.

1. quality: documents that the classifier rejects go.
2. lines: long lines that recur in many documents are dropped but from the last of them.
3. near_duplicates: of each group of documents with similar shingle sets, the one with the smallest id stays.
4. packing: what is left is packed into sequences.

Stages take and return the columns of ``documents``, the last one returns pieces. Rows that share an id stay or go together; rows without
an id stay unless they are similar to one that has an id. Documents left without text stay, as they are clean. An empty table passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.llm import linededup, ngramjoin, packing, quality
from postsift.llm.common import Scratch, table

#: Documents below this score are rejected.
KEEP_SCORE = 0.3
#: SQL cannot learn a classifier nor pack by local search; tests compare the stages with plain Python.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled ones of these documents; keep those that score well."""
    scratch = Scratch(spark, "pipeline-quality")
    measured = scratch.written(quality.with_statistics(docs), "measured")  # with the texts: measured once, and no join back to them
    model = quality.fit(measured.select("doc_id", *quality.STATISTICS), table(spark, sf_dir, "labels"))
    return measured.where(model.score() >= KEEP_SCORE).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that recur in five documents or more."""
    done = linededup.line_dedup(docs)
    done = done.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.length("kept_text").cast("long"))
    return done.select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join."""
    scratch = Scratch(spark, "pipeline-near")
    joined = ngramjoin.jaccard_join(docs)
    stays = F.max(F.col("doc").eqNullSafe(F.col("component_id")))
    gone = joined.groupBy("doc").agg(stays.alias("stays")).where(~F.col("stays")).select("doc")
    gone = scratch.written(gone, "gone", waves=2)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc"]), "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    scratch = Scratch(spark, "pipeline-packing")
    pieces = packing.cut(docs, public_tokenizers.path("byte_bpe_50k.json"))
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(scratch.written(pieces, "pieces", waves=8))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
    return docs
