"""Cluster validity indices and the sweep over k. All are linear in the rows, so no sample is needed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.functions import text as tx
from postsift.functions import vectors as vx
from postsift.operators import clusters
from postsift.sources import shipping, tables
from postsift.settings import ClusterSettings

K_METRICS = T.StructType(
    [
        T.StructField("k", T.IntegerType()),
        T.StructField("wcss", T.DoubleType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("calinski_harabasz", T.DoubleType()),
        T.StructField("davies_bouldin", T.DoubleType()),
    ]
)


def spread_per_cluster(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    """``(cluster, n, centre, within)`` with ``within`` the sum of squared distances to the centre, from
    one pass: counts, means and variances are merged per partition before the shuffle."""
    moments = Summarizer.metrics("count", "mean", "variance")
    return (
        df.select(cluster, array_to_vector(vx.doubles(F.col(vector))).alias("v"))
        .groupBy(cluster)
        .agg(moments.summary(F.col("v")).alias("s"))
        .select(
            cluster,
            F.col("s.count").alias("n"),
            vector_to_array("s.mean").alias("centre"),
            (
                F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda a, x: a + x)
                * (F.col("s.count") - 1)
            ).alias("within"),
        )
    )


def within_cluster_sum(df: DataFrame, cluster: str, vector: str) -> DataFrame:
    return spread_per_cluster(df, cluster, vector).agg(F.sum("within").alias("wcss"))


def calinski_harabasz(df: DataFrame, cluster: str, vector: str, max_clusters: int = 10_000) -> DataFrame:
    """(between / (k - 1)) / (within / (n - k)); null with fewer than two clusters."""
    packed = vx.as_one_value(
        spread_per_cluster(df, cluster, vector), cluster, "n", "centre", "within", max_rows=max_clusters
    )
    one = df.sparkSession.range(1).select(packed.alias("cs"))
    n = F.aggregate("cs", F.lit(0).cast("bigint"), lambda a, c: a + c["n"])
    centre_of_all = F.aggregate(
        "cs",
        F.transform(F.get(F.col("cs"), F.lit(0))["centre"], lambda x: F.lit(0.0)),
        lambda a, c: F.zip_with(a, c["centre"], lambda x, y: x + y * c["n"]),
    )
    base = one.select("cs", n.alias("n"), centre_of_all.alias("sums")).select(
        "cs", "n", F.transform("sums", lambda x: x / F.col("n")).alias("mean"), F.size("cs").alias("k")
    )
    between = F.aggregate(
        "cs", F.lit(0.0), lambda a, c: a + c["n"] * vx.squared_distance(c["centre"], F.col("mean"))
    )
    within = F.aggregate("cs", F.lit(0.0), lambda a, c: a + c["within"])
    score = F.try_divide(
        F.try_divide(between, F.col("k") - 1), F.try_divide(within, F.col("n") - F.col("k"))
    )
    return base.select(score.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, cluster: str, vector: str, max_clusters: int = 10_000) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij, s being the mean distance to the centre."""
    centres = vx.group_means(df, cluster, vector)
    packed = vx.as_one_value(centres, cluster, "centre", max_rows=max_clusters)
    own = F.get(F.filter("_centres", lambda c: c[cluster] == F.col(cluster)), F.lit(0))["centre"]
    scatter = (
        df.withColumn("_centres", packed)
        .withColumn("_own", own)
        .select(cluster, F.sqrt(vx.squared_distance(vx.doubles(F.col(vector)), F.col("_own"))).alias("d"))
        .groupBy(cluster)
        .agg(F.avg("d").alias("scatter"))
    )
    one = df.sparkSession.range(1).select(
        packed.alias("cs"),
        vx.as_one_value(scatter, cluster, "scatter", max_rows=max_clusters).alias("ss"),
    )
    # Both lists are sorted by cluster, so they line up.
    both = one.select(
        F.zip_with(
            "cs", "ss", lambda c, s: F.struct(c[cluster].alias("id"), c["centre"].alias("centre"), s["scatter"].alias("scatter"))
        ).alias("cs")
    )
    worst = F.transform(
        "cs",
        lambda a: F.array_max(
            F.transform(
                F.filter("cs", lambda b: b["id"] != a["id"]),
                lambda b: F.try_divide(
                    a["scatter"] + b["scatter"], F.sqrt(vx.squared_distance(a["centre"], b["centre"]))
                ),
            )
        ),
    )
    total = F.aggregate("w", F.lit(0.0), lambda s, x: s + x)
    return both.select(worst.alias("w")).select(
        F.when(F.size("w") >= 2, total / F.size("w")).alias("davies_bouldin")
    )


def silhouette_cosine(df: DataFrame, cluster: str, vector: str) -> float | None:
    """Exact mean silhouette with cosine distance; None with fewer than two clusters."""
    if df.select(cluster).distinct().limit(2).count() < 2:
        return None
    scored = df.select(
        F.col(cluster).cast("double").alias("p"), array_to_vector(vx.doubles(F.col(vector))).alias("v")
    )
    return ClusteringEvaluator(predictionCol="p", featuresCol="v", distanceMeasure="cosine").evaluate(scored)


def uniform_sample(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """About ``share`` of the rows, the same ones for the same seed."""
    return df.where(tx.stable_bucket(F.col(key), seed, 1_000_000) < round(share * 1_000_000))


def _matrix(block: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(block, np.float64).reshape(-1, dims)


def _blocks(vectors: DataFrame, vector: str, dims: int) -> DataFrame:
    """The vectors as rows of bytes, an Arrow batch each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(0)
            wrong = lists.null_count or lists.flatten().null_count or len(lists.flatten()) != dims * len(lists)
            if wrong:
                raise ValueError(f"sweep_k: a vector is null, holds nulls or has not {dims} components")
            yield pa.RecordBatch.from_arrays([pa.array([lists.flatten().to_numpy().tobytes()], pa.binary())], names=["block"])

    return vectors.select(vx.doubles(F.col(vector)).alias("v")).mapInArrow(run, "block binary")


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T)


def _moved(blocks: DataFrame, dims: int, centres: dict[int, np.ndarray], tol: float) -> dict[int, tuple[np.ndarray, float, bool]]:
    """One step of Lloyd's for each k: the new centres, the sum of squared distances to the old ones, and whether no centre moved by more than ``tol``.

    All k share the pass. A task gives one row for each k: sums and counts of its clusters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((len(c), dims + 1)) for k, c in centres.items()}
        cost = dict.fromkeys(centres, 0.0)
        for b in batches:
            for block in b.column(0).to_pylist():
                x = _matrix(block, dims)
                for k, c in centres.items():
                    d = _distances(x, c)
                    mine = d.argmin(1)
                    cost[k] += float(d[np.arange(len(x)), mine].sum())
                    member = np.zeros((len(c), len(x)))
                    member[mine, np.arange(len(x))] = 1
                    sums[k][:, :dims] += member @ x
                    sums[k][:, dims] += member.sum(1)
        rows = [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary()), pa.array(list(cost.values()), pa.float64())]
        yield pa.RecordBatch.from_arrays(rows, names=["k", "sums", "cost"])

    total = {k: np.zeros((len(c), dims + 1)) for k, c in centres.items()}
    cost = dict.fromkeys(centres, 0.0)
    for r in blocks.mapInArrow(run, "k int, sums binary, cost double").collect():
        total[r.k] += np.frombuffer(r.sums).reshape(-1, dims + 1)
        cost[r.k] += r.cost
    out = {}
    for k, c in centres.items():
        n = total[k][:, dims:]
        new = np.where(n > 0, total[k][:, :dims] / np.maximum(n, 1), c)  # an empty cluster stays where it is
        out[k] = new, cost[k], bool((((new - c) ** 2).sum(1) <= tol * tol).all())
    return out


def _labelled(blocks: DataFrame, dims: int, centres: dict[int, np.ndarray]) -> DataFrame:
    """``x`` and, for each k, the number of the nearest centre as ``k_<k>``."""
    names = [f"k_{k}" for k in centres]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.column(0).to_pylist():
                x = _matrix(block, dims)
                own = [pa.array(_distances(x, c).argmin(1), pa.int32()) for c in centres.values()]
                rows = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, dims), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([rows, *own], names=["x", *names])

    return blocks.mapInArrow(run, ", ".join(["x array<double>", *[f"{n} int" for n in names]]))


def sweep_k(
    df: DataFrame,
    vector: str = "x",
    ks: Iterable[int] = range(5, 21),
    s: ClusterSettings = ClusterSettings(),
    tol: float = 1e-4,
    parallelism: int = 8,
) -> DataFrame:
    """One row of metrics per k; k without enough rows, or with a single cluster, has nulls.

    The vectors are written once, in blocks. Each k starts from MLlib's own first centres; from there on all k take their steps in one
    pass over the vectors, so that there are as many passes as the slowest k needs, not their sum. Steps, tolerance and cost are those of
    MLlib's `KMeans`. ``wcss`` is of at most ``elbow_max_iter`` steps, the other metrics of at most ``max_iter``. Labels of all k are
    written in one more pass, and so many k are evaluated at a time. A task sends the driver the sums of all clusters.
    """
    spark: SparkSession = df.sparkSession
    shipping.ship(spark)
    ks = list(ks)
    vectors = tables.cut_lineage(df.select(vector))
    found = vectors.count()
    fitted = sorted({k for k in ks if 1 < k <= found}, reverse=True)
    out: dict[int, tuple] = {k: (k, None, None, None, None) for k in ks}
    if 1 in out and found:
        whole = within_cluster_sum(vectors.withColumn("_all", F.lit(0)), "_all", vector)
        out[1] = (1, whole.first()[0], None, None, None)
    if fitted:
        with ThreadPool(parallelism) as pool:
            each = lambda f: dict(zip(fitted, pool.map(inheritable_thread_target(spark)(f), fitted, chunksize=1)))
            centres = each(lambda k: np.array(clusters.fit_kmeans(vectors, vector, k, s, max_iter=0).clusterCenters()))
            dims = next(iter(centres.values())).shape[1]
            blocks = tables.cut_lineage(_blocks(vectors, vector, dims))
            wcss: dict[int, float] = {}
            going = dict(centres)
            for step in range(1, max(s.max_iter, s.elbow_max_iter) + 1):
                for k, (new, cost, still) in _moved(blocks, dims, going, tol).items():
                    if step <= s.elbow_max_iter:
                        wcss[k] = cost
                    centres[k] = new
                    if still:
                        del going[k]
                    else:
                        going[k] = new
                if not going:
                    break
            labelled = tables.cut_lineage(_labelled(blocks, dims, centres))

            def metrics(k: int) -> tuple:
                own = labelled.select(F.col(f"k_{k}").alias("cluster_id"), "x")
                sil = silhouette_cosine(own, "cluster_id", "x")
                ch = calinski_harabasz(own, "cluster_id", "x").first()[0]
                db = davies_bouldin(own, "cluster_id", "x").first()[0]
                return k, wcss[k], sil, ch if sil is not None else None, db

            out |= each(metrics)
    return spark.createDataFrame([out[k] for k in ks], K_METRICS)
