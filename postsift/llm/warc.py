"""WARC archives as a Spark data source, and the marking of payloads that are already archived.

``read_warc`` plans partitions of whole files, takes record types and predicates on headers from the query's filters,
parses the headers of a record first, and steps over the block of a record that no one wants (plain files: by a seek;
``.gz``: without keeping it). ``write_warc`` lets each task write files of its own below ``_temporary``; the commit moves
those of the successful attempts, so lost executors and repeated tasks leave no double records.

Files may be on any file system that ``pyarrow.fs`` opens by its URI. A file is rolled at ``roll_bytes``, so that a partition
of the reader stays bounded; a record is held in memory as a whole, batches of records up to ``BATCH`` bytes.

Defined results: a null payload is an empty one; line breaks in header values are percent-encoded; null headers are left out
and read as null; records of unknown types are read like others; records without a record id are kept. A file that ends
inside a record raises. Rows with the same id and equal payloads are all responses. Null ids are never referred to.
"""

from __future__ import annotations

import gzip
import io
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from postsift.sources.shipping import ship

#: Column of the table and header of the record (fixed names of the format; the last one is an extension).
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
    "payload_length": "WARC-Payload-Length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NUMBERS = ("content_length", "payload_length")
SCHEMA = ", ".join(f"{c} {'long' if c in NUMBERS else 'string'}" for c in HEADERS) + ", payload binary"
ARROW = pa.schema([(c, pa.int64() if c in NUMBERS else pa.string()) for c in HEADERS] + [("payload", pa.binary())])
#: Bytes of payloads in a batch, of a read, of files in a partition.
BATCH, BLOCK, PARTITION = 8 << 20, 1 << 20, 64 << 20

TESTS: dict[type, Callable] = {
    EqualTo: lambda have, want: have == want,
    GreaterThan: lambda have, want: have > want,
    GreaterThanOrEqual: lambda have, want: have >= want,
    LessThan: lambda have, want: have < want,
    LessThanOrEqual: lambda have, want: have <= want,
    In: lambda have, want: have in want,
    StringStartsWith: lambda have, want: have.startswith(want),
    IsNotNull: lambda have, want: True,
}


def records(stream: io.BufferedReader, seekable: bool) -> Iterator[tuple[dict[str, str], Callable[[bool], bytes]]]:
    """Headers of each record, by column, and a function that returns the block or steps over it; call it once."""
    names = {h.lower(): c for c, h in HEADERS.items()}
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        found: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            if (column := names.get(name.strip().lower())) and column not in found:
                found[column] = value.strip()
        length = int(found["content_length"])

        def block(wanted: bool, length: int = length) -> bytes:
            if wanted:
                data = stream.read(length)
                if len(data) < length:
                    raise ValueError("the file ends inside a record")
                return data
            if seekable:
                stream.seek(length, io.SEEK_CUR)
            else:
                left = length
                while left and (n := len(stream.read(min(left, BLOCK)))):
                    left -= n
            return b""

        yield found, block


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP header, if it has one."""
    if headers.get("content_type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload = path, payload
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if type(f) in TESTS and column in HEADERS:
                self.tests.append((column, type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=False))
        files = sorted((f.path, f.size) for f in found if f.is_file and not f.base_name.startswith(("_", ".")))
        groups: list[list[str]] = []
        size = PARTITION
        for path, n in files:
            if size + n > PARTITION:
                groups.append([])
                size = 0
            groups[-1].append(path)
            size += n
        return [InputPartition(g) for g in groups or [[]]]

    def wanted(self, headers: dict) -> bool:
        return all(headers.get(c) is not None and TESTS[kind](headers[c], value) for c, kind, value in self.tests)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows: list[dict] = []
        size = 0
        for path in partition.value:
            with fs.open_input_file(path) as raw:
                packed = path.endswith(".gz")
                stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if packed else raw, BLOCK)
                for headers, block in records(stream, not packed):
                    row = {c: int(v) if c in NUMBERS else v for c, v in headers.items()}
                    if not self.wanted(row):
                        block(False)
                        continue
                    row["payload"] = payload_of(headers, block(self.payload)) if self.payload else block(False) or None
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= BATCH:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


@dataclass
class Files(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


def header_value(v: object) -> str:
    """Control characters would end the header."""
    text = str(v)
    return text if text.isprintable() else "".join(c if ord(c) >= 32 else f"%{ord(c):02X}" for c in text)


def record(row: dict) -> bytes:
    """One record. Responses have their payload behind an HTTP header, revisits have none."""
    payload = row.get("payload") or b""
    revisit = row["record_type"] == "revisit"
    kind, block = row.get("content_type"), b"" if revisit else payload
    if row["record_type"] == "response":
        kind = "application/http; msgtype=response"
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
    values = row | {"content_type": kind, "content_length": len(block)}
    lines = ["WARC/1.1", *(f"{h}: {header_value(values[c])}" for c, h in HEADERS.items() if values.get(c) is not None)]
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, roll_bytes: int, packed: bool, overwrite: bool):
        self.path, self.roll_bytes, self.packed, self.overwrite = path, roll_bytes, packed, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        done, out, size = Files(), None, 0
        try:
            for batch in iterator:
                for i in range(batch.num_rows):
                    data = record({c: batch.column(k)[i].as_py() for k, c in enumerate(batch.schema.names)})
                    data = gzip.compress(data, 1) if self.packed else data
                    if out is None or size + len(data) > self.roll_bytes:
                        if out is not None:
                            out.close()
                        done.names.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.packed)
                        out, size = io.BufferedWriter(fs.open_output_stream(f"{root}/_temporary/{done.names[-1]}", compression=None), BLOCK), 0
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list[Files | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(root)):
                if f.is_file:
                    fs.delete_file(f.path)
        for name in (n for m in messages if m for n in m.names):
            fs.move(f"{root}/_temporary/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Files | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        if fs.get_file_info(f"{root}/_temporary").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/_temporary")


class WarcSource(DataSource):
    """Options: path; payload (false: headers only); roll_bytes; compress (one gzip member per record)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        packed = self.options.get("compress", "false") == "true"
        return WarcWriter(self.options["path"], int(self.options.get("roll_bytes", PARTITION)), packed, overwrite)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives in a folder; filters on headers are applied before blocks are read."""
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def write_warc(df: DataFrame, path: str, compress: bool = False, roll_bytes: int = PARTITION, mode: str = "append") -> None:
    """Write records; ``df`` has ``record_type`` and any other columns of ``SCHEMA``."""
    register(df.sparkSession)
    known = [c for c in (*HEADERS, "payload") if c in df.columns]
    rows = df.select(*known).to(df.sparkSession.createDataFrame([], SCHEMA).schema)
    writer = rows.write.format("warc").option("compress", str(compress).lower()).option("roll_bytes", str(roll_bytes))
    writer.mode(mode).save(path)


#: Digits of base 32.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of bytes in upper-case base32: 5 hexadecimal digits make 4 of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", ALPHABET)


def mark_revisits(df: DataFrame, key: str, payload: str, written: Callable[[DataFrame, str], DataFrame], min_bytes: int = 0) -> DataFrame:
    """``df`` with ``payload_digest``, ``record_type`` and ``refers_to`` (the key of the response for revisits).

    Of rows with equal payloads of at least ``min_bytes`` bytes, the one with the smallest key is the response. Only keys
    and digests are grouped, counted per partition first; ``written`` stores the list of revisits, so that the join with
    the payloads sees its size.
    """
    new = ("payload_digest", "record_type", "refers_to")
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in new]).alias("row")
    rows = df.select(whole, F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{payload}`"), F.lit(b"")).alias("bytes"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("bytes")))
    known = rows.where(F.length("bytes") >= min_bytes).select("key", "payload_digest")
    first = known.groupBy("payload_digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    again = known.join(first, "payload_digest").where(~F.col("key").eqNullSafe(F.col("first")))
    again = written(again.select(F.col("key").alias("again"), F.col("payload_digest").alias("same"), "first").distinct(), "revisits")
    joined = rows.join(again, F.col("key").eqNullSafe(F.col("again")) & (F.col("payload_digest") == F.col("same")), "left")
    kind = F.when(F.col("same").isNull(), "response").otherwise("revisit")
    return joined.select("row.*", "payload_digest", kind.alias("record_type"), F.col("first").alias("refers_to"))
