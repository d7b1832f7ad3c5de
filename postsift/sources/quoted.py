"""Quoted CSV of any size, read by many tasks: line breaks inside quotes, in files that are cut into blocks anywhere.

A line break ends a record if the number of quotes before it is even. A block does not know how many came before it, but it knows its
own, so this is a prefix sum over blocks:

1. Each task counts quotes per line of its blocks. For both cases, an even or odd number before the block, a line gets the last line of the block on
   which a record begins.
2. One row per block goes to a window over the blocks of a file, which gives the number of quotes before each, and the last
   beginning of a record in the blocks before.
3. Blocks' rows are joined to lines. A record of one line, as most are, is done; lines of others are grouped by where their record begins.

Lines are not shuffled in steps 1 and 2, nor in 3 if the blocks' rows are few enough to be broadcast. Quotes inside quotes are doubled,
and a field with a quote in it is quoted, as RFC 4180 has it; a file that ends inside quotes raises before anything is grouped, as its
last record would be without bound.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.schema import RAW_MESSAGES
from postsift.sources import tables


class OpenQuote(ValueError):
    """A file ends inside quotes."""


LINES = "path string, block long, value string, line long, even long, odd long, before byte, after byte"


def counted_lines(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """Lines of all files by ``path`` and ``block`` (where it begins), numbered from 0.

    ``before``, ``after``: whether the block's quotes before and after the line are odd. ``even``, ``odd``: the last line, up to this one,
    with an even or odd number of quotes before it; -1 for none.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, line, quotes, last = None, 0, 0, [-1, -1]
        for whole in batches:
            path_, block = whole.column(0), whole.column(1).to_numpy()
            new = np.append(True, (np.diff(block) != 0) | pc.not_equal(path_[1:], path_[:-1]).to_numpy(zero_copy_only=False))
            borders = [*np.flatnonzero(new).tolist(), whole.num_rows]
            for a, b in zip(borders, borders[1:]):
                part = whole.slice(a, b - a)
                if (own := (path_[a].as_py(), int(block[a]))) != name:
                    name, line, quotes, last = own, 0, 0, [-1, -1]
                n = pc.count_substring(part.column(2), quote).to_numpy().astype(np.int64)
                after = quotes + np.cumsum(n)
                odd = (after - n) % 2
                at = np.arange(line, line + len(n))
                begins = [np.maximum.accumulate(np.maximum(np.where(odd == k, at, -1), last[k])) for k in (0, 1)]
                line, quotes, last = line + len(n), int(after[-1]), [int(x[-1]) for x in begins]
                parity = [pa.array(x.astype(np.int8)) for x in (odd, after % 2)]
                names = ["path", "block", "value", "line", "even", "odd", "before", "after"]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(at), *map(pa.array, begins), *parity], names=names)

    return lines.mapInArrow(run, LINES)


def block_starts(lines: DataFrame) -> DataFrame:
    """``path, block, inside`` (1 if the block begins inside quotes), ``from_block, from_line``: where the record begins that is open there."""
    blocks = lines.groupBy("path", "block").agg(
        F.max_by("after", "line").cast("int").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd")
    )
    order = Window.partitionBy("path").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("inside", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int"))
    begin = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    begin = F.when(begin >= 0, F.struct(F.col("block").alias("b"), begin.alias("l")))
    blocks = blocks.withColumn("begin", begin).withColumn("open", F.last("begin", ignorenulls=True).over(earlier))
    return blocks.select("path", "block", "inside", "quotes", F.col("open.b").alias("from_block"), F.col("open.l").alias("from_line"))


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """``path, block, line, record``: whole records with their inner line breaks, and where they begin; in no order. Empty lines between records
    are left out."""
    lines = counted_lines(spark, path, quote)
    starts = tables.cut_lineage(block_starts(lines))
    ends = starts.groupBy("path").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").limit(1).collect()
    if ends:
        raise OpenQuote(f"{ends[0].path} ends inside quotes")
    met = lines.join(starts.drop("quotes"), ["path", "block"])
    own = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    met = met.withColumn("own", own)
    begins, done = F.col("own") == F.col("line"), F.col("after") == F.col("inside")
    one = met.where(begins & done).select("path", "block", "line", F.col("value").alias("record"))
    parts = met.where(~(begins & done)).select(
        "path",
        F.when(F.col("own") >= 0, F.col("block")).otherwise(F.col("from_block")).alias("b"),
        F.when(F.col("own") >= 0, F.col("own")).otherwise(F.col("from_line")).alias("l"),
        F.struct("block", "line", "value").alias("part"),
    )
    whole = parts.groupBy("path", "b", "l").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    whole = whole.select("path", F.col("b").alias("block"), F.col("l").alias("line"), F.array_join("parts.value", "\n").alias("record"))
    found = one.unionByName(whole).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return found.where("record <> ''")


def read_large_csv(
    spark: SparkSession, path: str, schema: T.StructType = RAW_MESSAGES, drop_na_tokens: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    """What `tables.read_messages_csv` gives with line breaks in quotes, from files of any size, each read by many tasks.

    All files have the same header, on their first line. Line breaks in quotes stay as they are, in files that end lines with \\r\\n, too.
    """
    found = records(spark, path)
    first = (F.col("block") == 0) & (F.col("line") == 0)
    heads = found.where(first).select(F.regexp_replace("record", "^﻿", "").alias("h")).distinct().limit(2).collect()
    if len(heads) > 1:
        raise ValueError(f"read_large_csv: files of {path} have different headers")
    names = next(csv.reader([heads[0].h]), []) if heads else []
    return tables.typed_messages(parsed(found.where(~first), names), names, schema, drop_na_tokens, keep_corrupt, "read_large_csv")


def parsed(found: DataFrame, names: list[str]) -> DataFrame:
    """Text columns of records; ``_bad`` is a record that has more or fewer fields."""
    fields = ", ".join("`" + n.replace("`", "``") + "` string" for n in names) + ", `_bad` string"
    options = tables.CSV_OPTIONS | {"header": False, "multiLine": True, "nullValue": tables.NO_VALUE, "emptyValue": "", "columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"}
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    return found.select(F.from_csv("record", fields, options).alias("r")).select("r.*")
