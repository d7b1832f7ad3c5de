"""KMeans on reduced vectors, naming of clusters, pseudo-labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.functions import vectors as vx
from postsift.schema import CATEGORY_MAP, RAW_COLUMNS, project, require_columns
from postsift.settings import ClusterSettings


class TooFewVectors(ValueError):
    """Fewer vectors than clusters asked for."""


def _as_vector(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("_vector", array_to_vector(F.col(vector).cast("array<double>")))


def fit_kmeans(
    df: DataFrame, vector: str = "x", k: int | None = None, s: ClusterSettings = ClusterSettings(), max_iter: int | None = None
) -> KMeansModel:
    k = k or s.k
    if k > s.max_clusters:
        raise ValueError(f"k={k} above max_clusters={s.max_clusters}")
    vectors = _as_vector(df.select(vector), vector).select("_vector")
    # Stops counting at k rows.
    found = vectors.limit(k).count()
    if found < k:
        raise TooFewVectors(f"{found} vectors for k={k}")
    return KMeans(
        featuresCol="_vector",
        predictionCol="cluster_id",
        k=k,
        seed=s.seed,
        maxIter=s.max_iter if max_iter is None else max_iter,
    ).fit(vectors)


def assign_clusters(df: DataFrame, model: KMeansModel, vector: str = "x") -> DataFrame:
    """Adds ``cluster_id`` from a fitted model; an empty table gives an empty result."""
    return model.transform(_as_vector(df, vector)).drop("_vector")


def assignments(df: DataFrame, key: str = "tweet_id") -> DataFrame:
    return df.select(key, "cluster_id")


def nearest_centre(
    df: DataFrame, centres: DataFrame, key: str, vector: str, cluster: str, max_clusters: int = 10_000
) -> DataFrame:
    """``(key, nearest, distance)`` against a centre table ``(cluster, centre)``.

    Row-local: the centres travel as one value of checked size, points are neither joined nor shuffled.
    """
    packed = vx.as_one_value(centres, cluster, "centre", max_rows=max_clusters)
    best = vx.nearest(vx.doubles(F.col(vector)), F.col("_centres"), cluster)
    return df.withColumn("_centres", packed).withColumn("_best", best).select(
        key, F.col(f"_best.{cluster}").alias("nearest"), F.col("_best.distance").alias("distance")
    )


def with_text(assigned: DataFrame, texts: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Left join of the assignments to their texts."""
    return assigned.join(texts, key, "left")


def category_table(spark, names: Mapping[int, str] | DataFrame, k: int | None = None) -> DataFrame:
    """Cluster names as a table. Cluster numbers belong to one fitted model: with ``k`` given, a name
    for a cluster the model does not have is an error."""
    if isinstance(names, DataFrame):
        table = names.select(F.col("cluster_id").cast("int").alias("cluster_id"), "category")
        outside = table.where((F.col("cluster_id") < 0) | (F.col("cluster_id") >= (k or 1 << 30)))
        if k is not None and not outside.isEmpty():
            raise ValueError(f"category map names clusters outside 0..{k - 1}")
        return table
    if k is not None and any(not 0 <= c < k for c in names):
        raise ValueError(f"category map names clusters outside 0..{k - 1}")
    return spark.createDataFrame([(int(c), n) for c, n in sorted(names.items())], CATEGORY_MAP)


def label_clusters(
    df: DataFrame, categories: DataFrame, cluster: str = "cluster_id", max_clusters: int = 10_000
) -> DataFrame:
    """Adds ``category``; null where the cluster has no name. The map is one value of checked size, so
    a cluster that holds a third of the rows does not meet in one task."""
    lookup = vx.as_one_map(categories, "cluster_id", "category", max_clusters)
    return df.withColumn("category", F.element_at(lookup, F.col(cluster).cast("int")))


def unmapped_clusters(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return (
        df.where(F.col("category").isNull()).groupBy(cluster).agg(F.count(F.lit(1)).alias("n_rows"))
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def pseudo_labelled(df: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Id, texts, cluster, category, then the other raw columns that are there."""
    first = [key, "text", "text_preprocessed", "cluster_id", "category"]
    rest = [c for c in (*RAW_COLUMNS, "split") if c not in first and c in df.columns]
    require_columns(df, [key, "cluster_id", "category"], "pseudo_labelled")
    return project(df, [c for c in first if c in df.columns] + rest)


def sample_per_cluster(
    df: DataFrame, cluster: str, key: str, n: int, seed: int = 42
) -> DataFrame:
    """Up to ``n`` rows per cluster, the same ones for the same seed. The rank limit is applied per
    input partition before the shuffle, so no cluster is gathered whole."""
    w = Window.partitionBy(cluster).orderBy(tx.sample_order(F.col(key), seed), F.col(key))
    return df.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n)
