"""Cluster report: size, keywords, samples and a slot for the name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.operators import clusters, keywords
from postsift.sources.tables import cut_lineage

# What the report shows for texts that have nothing to show.
MISSING_TEXT = "[TEXT MISSING]"
BLANK_TEXT = "[TEXT BLANK]"
NAME_SLOT = "[NAME ME]"


def shown(c: Column) -> Column:
    return F.when(c.isNull(), MISSING_TEXT).when(tx.is_blank(c), BLANK_TEXT).otherwise(c)


def cluster_report(
    df: DataFrame,
    cluster: str = "cluster_id",
    key: str = "tweet_id",
    texts: Sequence[str] = ("text", "text_preprocessed"),
    keyword_text: str = "text_preprocessed",
    n_samples: int = 50,
    n_keywords: int = 15,
    stop: Sequence[str] = (),
    seed: int = 42,
) -> DataFrame:
    """One row per cluster: ``n_rows, keywords, samples, category_slot``. Lists are bounded by the two
    counts asked for; the clusters' rows themselves are only counted. ``key`` identifies a row.

    Samples are drawn on cluster and key alone and written; their texts are fetched afterwards, so that
    Spark knows the size of the drawn keys.
    """
    texts = [c for c in texts if c in df.columns]
    sizes = clusters.distribution(df, cluster)
    terms = (
        keywords.top_keywords(df, cluster, keyword_text, n_keywords, stop)
        .groupBy(cluster)
        .agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t"))
        .select(F.col(cluster).alias("_of_terms"), F.transform("t", lambda x: x["term"]).alias("keywords"))
    )
    drawn = cut_lineage(
        clusters.sample_per_cluster(df.select(cluster, key), cluster, key, n_samples, seed).drop(cluster)
    )
    picked = df.select(cluster, key, *texts).join(drawn, key)
    samples = picked.groupBy(F.col(cluster).alias("_of_samples")).agg(
        F.array_sort(
            F.collect_list(
                F.struct("sample_rank", F.col(key), *[shown(F.col(c)).alias(c) for c in texts])
            )
        ).alias("samples")
    )
    none = F.array().cast("array<string>")
    return (
        sizes.join(terms, F.col(cluster).eqNullSafe(F.col("_of_terms")), "left")
        .join(samples, F.col(cluster).eqNullSafe(F.col("_of_samples")), "left")
        .select(
            cluster,
            "n_rows",
            F.coalesce("keywords", none).alias("keywords"),
            "samples",
            F.lit(NAME_SLOT).alias("category_slot"),
        )
    )


def report_text(report: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """The report as one text per cluster, for a reader who names the clusters."""
    fields = [f.name for f in report.schema["samples"].dataType.elementType.fields if f.name != "sample_rank"]
    lines = F.transform(
        "samples",
        lambda s: F.concat_ws("\n", *[F.concat(F.lit(f"  {f}: "), s[f].cast("string")) for f in fields]),
    )
    body = F.concat_ws(
        "\n",
        F.format_string("== cluster %s (%s rows) ==", F.col(cluster).cast("string"), F.col("n_rows").cast("string")),
        F.array_join(lines, "\n--\n"),
        F.concat(F.lit("keywords: "), F.array_join("keywords", ", ")),
        F.concat(F.lit("name: "), F.col("category_slot")),
    )
    return report.select(cluster, body.alias("report"))
