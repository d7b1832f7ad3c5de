"""Reading and writing of stage tables, vectors and intermediate results."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.schema import RAW_COLUMNS, RAW_MESSAGES, MissingColumns, require_columns

# Used only where a session names no shared folder, as in tests on a local master.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"
# What the reader takes a field with nothing in it for, so that a quoted empty text stays a text: private characters.
NO_VALUE = "\ue000none\ue001"


# An empty text and a missing one look different: ``""`` and nothing between the commas.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "quote": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "encoding": "UTF-8",
}


def read_messages_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_MESSAGES,
    multiline: bool = True,
    drop_na_tokens: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Raw message CSV with a header row and quoted line breaks; columns are taken by the names in the header.

    The file may have other columns, and any order; a declared column that is absent raises. All files of
    ``path`` must have the same header. A multi-line file is read by one task: for large files use `quoted.read_large_csv`,
    or pass ``multiline=False`` when no text holds a line break. ``drop_na_tokens``
    treats texts such as ``NA`` as missing. ``keep_corrupt`` adds ``_corrupt_record``: the row as JSON if a
    value does not fit its type, or if the row has more or fewer fields than the header.
    """
    options = CSV_OPTIONS | {"multiLine": multiline, "nullValue": "", "emptyValue": ""}
    header = spark.read.options(**options).option("inferSchema", False).csv(path).columns
    rough = T.StructType([*[T.StructField(c, T.StringType()) for c in header], T.StructField("_bad", T.StringType())])
    reader = spark.read.schema(rough).options(**CSV_OPTIONS).options(multiLine=multiline, nullValue=NO_VALUE, emptyValue="", enforceSchema=True)
    df = reader.option("columnNameOfCorruptRecord", "_bad").option("mode", "PERMISSIVE").csv(path)
    return typed_messages(df, header, schema, drop_na_tokens, keep_corrupt, "read_messages_csv")


def typed_messages(df: DataFrame, header: list[str], schema: T.StructType, drop_na_tokens: bool, keep_corrupt: bool, reader: str) -> DataFrame:
    """The declared columns of a table of texts with a column ``_bad``, by name and with their types."""
    if missing := [f.name for f in schema.fields if f.name not in header]:
        raise MissingColumns(f"{reader}: missing {missing}, header has {header}")
    # Nothing between the commas is null; only a quoted empty text is empty.
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    wrong = [F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in schema.fields]
    corrupt = F.coalesce("_bad", F.when(reduce(lambda a, b: a | b, wrong), F.to_json(F.struct(*[F.col(f"`{c}`") for c in header]))))
    df = df.select(*typed, *([corrupt.alias("_corrupt_record")] if keep_corrupt else []))
    if drop_na_tokens and "text" in df.columns:
        # Texts read as missing when asked to.
        na = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "#N/A", "<NA>"]
        df = df.withColumn("text", F.when(~F.col("text").isin(*na), F.col("text")))
    return df


def read_table(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Stage table; with ``split`` only that partition directory is listed and read."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by_split: bool = True) -> None:
    """Parquet, partitioned by split when there is one. An empty table keeps its schema."""
    writer = df.write.mode(mode)
    if by_split and "split" in df.columns:
        writer = writer.partitionBy("split")
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 CSV with a header, quotes doubled, white space kept; readable by `read_messages_csv`."""
    df.write.mode(mode).options(**CSV_OPTIONS).options(nullValue="", emptyValue='""').csv(path)


def write_text(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    df.select(column).write.mode(mode).text(path)


def raw_columns(df: DataFrame) -> DataFrame:
    require_columns(df, RAW_COLUMNS, "raw_columns")
    return df.select(*RAW_COLUMNS)


class BadVectors(ValueError):
    """Vector table with null, wrongly sized or ambiguous rows."""


def vector_problems(df: DataFrame, key: str = "tweet_id", vector: str = "embedding", dims: int | None = None) -> DataFrame:
    """One row: ``n_rows, n_null, n_wrong_size, n_repeated_keys``. The right size is ``dims`` or, without
    it, the most common one."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(vector).isNull()).alias("nulls"),
        F.collect_set(F.size(vector)).alias("sizes"),
    )
    if dims is None:
        # One row per length; the most common wins, the longer one on a tie.
        lengths = df.where(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("d")).count()
        target = lengths.agg(F.max(F.struct("count", "d")).alias("m")).select("m.d").scalar()
    else:
        target = F.lit(dims)
    wrong = F.size(F.filter("sizes", lambda d: (d >= 0) & (d != F.col("target")))) > 0
    return per_key.withColumn("target", target).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("n_null"),
        F.count_if(wrong).alias("n_wrong_size"),
        F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
    )


def save_vectors(df: DataFrame, path: str, key: str = "tweet_id", vector: str = "embedding") -> None:
    """Key and vector in the same row, so they cannot drift apart."""
    extra = [c for c in ("split",) if c in df.columns]
    write_table(df.select(key, F.col(vector).cast("array<float>").alias(vector), *extra), path)


def load_vectors(
    spark: SparkSession, path: str, key: str = "tweet_id", vector: str = "embedding", dims: int | None = None
) -> DataFrame:
    """Read vectors back; raises if any is null, of another length, or shares its key."""
    df = require_columns(read_table(spark, path), [key, vector], "load_vectors")
    found = vector_problems(df, key, vector, dims).first()
    if found.n_rows == 0 or found.n_null or found.n_wrong_size or found.n_repeated_keys:
        raise BadVectors(str(found.asDict()))
    return df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rebalance a small scan over the cores before per-row work that multiplies rows.

    Large tables already have more input partitions than cores and are returned as they are, without a
    shuffle. Only for plain scans: asking for the partitions of a shuffled plan would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, or the one set on the context.

    Raises on a cluster that names none; on a local master, which is one machine, it is ``LOCAL_CHECKPOINTS``.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{LOCAL_CHECKPOINTS}"


def run_folder(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables; `remove_intermediates` deletes it."""
    return f"{shared_folder(spark)}/postsift-{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows below the shared folder and go on from the written table.

    A Parquet table rather than ``checkpoint()``: columns are pruned on reading, and its size is known, so
    that small results are broadcast. A lost executor costs its running tasks only.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_intermediates(spark: SparkSession) -> None:
    """Delete what `cut_lineage` wrote in this application; tables read from it are gone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
