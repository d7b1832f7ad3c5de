"""What the operators share: shared scratch tables, protected columns, text without nulls."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from postsift.sources.shipping import ship
from postsift.sources.tables import run_folder


class Scratch:
    """Tables of one job, written to a folder of its own below the application's, which `tables.remove_intermediates` deletes.

    A written table cuts the lineage: an executor that is lost later costs the tasks it ran, not the stages before.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.folder = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def written(self, df: DataFrame, name: str, waves: int = 0) -> DataFrame:
        """Write and read back. ``waves``: for rows without texts, in no more files than so many waves of tasks over all
        cores write, as a small file costs more than its rows."""
        path = f"{self.folder}/{name}"
        files = waves * self.spark.sparkContext.defaultParallelism
        (df.coalesce(files) if files else df).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def remove(self, name: str = "") -> None:
        """Delete one table, or all, once nothing reads it any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def batches_of(df: DataFrame, work: Callable[[pa.RecordBatch], Iterator[tuple[int, int, dict]]], new: dict[str, DataType]) -> DataFrame:
    """``df`` with columns computed per Arrow batch; columns of the same names are replaced, others kept whatever they are called.

    ``work`` yields, for consecutive slices of a batch, where they begin and end and their new columns.
    """
    ship(df.sparkSession)
    kept = [i for i, c in enumerate(df.columns) if c not in new]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # names that are repeated or hold dots would not resolve
    fields = plain.schema.fields
    names = [f"c{i}" for i in kept] + [f"new{i}" for i in range(len(new))]
    schema = StructType([fields[i] for i in kept] + [StructField(f"new{i}", t) for i, t in enumerate(new.values())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin, end, columns in work(whole):
                b = whole.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], *[columns[c] for c in new]], names=names)

    return plain.mapInArrow(run, schema).toDF(*[df.columns[i] for i in kept], *new)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text column; null is empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def by_key(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the columns an operator needs, under its own names, so that other columns cannot clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])
