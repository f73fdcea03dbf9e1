"""ARC and WARC files as DataFrames of records and captures."""

from __future__ import annotations

import io

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstrata.functions.content import parse_http
from crawlstrata.functions.dates import capture_ts
from crawlstrata.functions.keys import url_key
from crawlstrata.schema import CAPTURES, RECORDS
from crawlstrata.sources.records import first_member, read_records

# Which files are archives.
ARCHIVE_FILES = "*.{arc,warc,arc.gz,warc.gz}"
# A batch handed to the JVM is closed at either size; one record may exceed the byte size alone.
BATCH_ROWS = 2048
BATCH_BYTES = 32 << 20
# Bytes of a compressed archive that one task reads, and how far apart the offsets of two splits are at least.
SPLIT_BYTES = 128 << 20
SPLIT_SPAN = 1 << 44

ARROW_RECORDS = pa.schema([
    ("source_file", pa.string()),
    ("source_offset", pa.int64()),
    ("format", pa.string()),
    ("record_type", pa.string()),
    ("url", pa.string()),
    ("ip", pa.string()),
    ("capture_date", pa.string()),
    ("content_type", pa.string()),
    ("payload_length", pa.int64()),
    ("headers", pa.map_(pa.string(), pa.string())),
    ("payload", pa.binary()),
    ("error", pa.string()),
])


def file_system(path: str):
    """The Arrow file system of a path or URI (local, HDFS, S3, GCS) and the path inside it.

    Local paths are taken as Spark writes them: nothing in them is escaped.
    """
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1) if path.startswith("file:") else path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def _open(path: str):
    system, inside = file_system(path)
    return io.BufferedReader(system.open_input_stream(inside, compression=None), 1 << 20)


def _batch(rows):
    for row in rows:
        if row["headers"] is not None:
            row["headers"] = list(row["headers"].items())
    return pa.RecordBatch.from_pylist(rows, schema=ARROW_RECORDS)


def batches_of(rows):
    """The rows as Arrow batches, none of them over the sizes by more than one record."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["payload"] or b"")
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def rows_of_file(path: str, keep_limit, version: bytes, wants=None, data: bytes | None = None):
    """Rows of one archive, streamed from its storage or read from the `data` at hand."""
    with _open(path) if data is None else io.BufferedReader(io.BytesIO(data)) as stream:
        yield from read_records(stream, path, keep_limit, version, wants=wants)


def rows_of_split(path: str, start: int, end: int, number: int, keep_limit, version: bytes, wants=None):
    """Rows of the members that begin in one split of an archive."""
    system, inside = file_system(path)
    with system.open_input_file(inside) as file:

        def member_from(at: int) -> int | None:
            file.seek(at)
            return first_member(file, at)

        first = start if start == 0 else member_from(start)
        if first is None or first >= end and start > 0:
            return
        # The next split's first member, by the same search: what lies before it is read here.
        stop = member_from(end) if end < file.size() else None
        file.seek(first)
        raw = io.BufferedReader(_Plain(file), 1 << 20)
        yield from read_records(raw, path, keep_limit, version, first, stop, number * SPLIT_SPAN, wants)


def _decoder(keep_limit, version: bytes):
    def rows_of(batch):
        held = batch.column("content") if "content" in batch.schema.names else None
        for i, path in enumerate(batch.column("path").to_pylist()):
            yield from rows_of_file(path, keep_limit, version, data=None if held is None else held[i].as_py())

    return lambda batches: batches_of(row for batch in batches for row in rows_of(batch))


def _split_decoder(keep_limit, version: bytes):
    def decode(batches):
        splits = (split for batch in batches for split in zip(*(c.to_pylist() for c in batch.columns)))
        yield from batches_of(row for split in splits for row in rows_of_split(*split, keep_limit, version))

    return decode


class _Plain(io.RawIOBase):
    """An Arrow file as Python's buffers want it; it stays open when they close."""

    def __init__(self, file):
        self.file = file

    def readable(self):
        return True

    def readinto(self, into) -> int:
        data = self.file.read(len(into))
        into[: len(data)] = data
        return len(data)


def archive_splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, start, end, number) of the parts that `decode_splits` reads.

    Compressed archives are cut every `split_bytes` bytes, others are one split: nothing in them tells where a
    record begins.
    """
    size = F.when(F.col("path").endswith(".gz"), F.lit(split_bytes)).otherwise(F.greatest("length", F.lit(1)))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), size.cast("long"))
    cut = files.select("path", "length", size.alias("_size"), F.posexplode(starts).alias("number", "start"))
    end = F.least(F.col("start") + F.col("_size"), F.greatest("length", F.lit(1)))
    return cut.select("path", "start", end.cast("long").alias("end"), F.col("number").cast("long").alias("number"))


def decode_splits(splits: DataFrame, max_bytes: int | None = None, version: str = "WARC/") -> DataFrame:
    """Records of the archives' `splits`, each once: a split has the members that begin in it.

    Where a member begins is found from the split's own first byte on, so no split waits for another. A file that
    is one member, or whose records do not begin with members, is read by its first split. `source_offset` is the
    decoded offset in the split, from number * SPLIT_SPAN on: unique and in the order of the file.
    """
    return splits.mapInArrow(_split_decoder(max_bytes, version.encode()), RECORDS)


def decode_files(files: DataFrame, max_bytes: int | None = None, version: str = "WARC/") -> DataFrame:
    """Records of the archives in `files`.

    `files` has a `path` column, and a `content` column where the bytes are already at hand; otherwise
    each task opens and streams its own files. Payloads over `max_bytes` are counted but not kept.
    """
    return files.mapInArrow(_decoder(max_bytes, version.encode()), RECORDS)


def archive_files(spark: SparkSession, path: str, with_bytes: bool = False) -> DataFrame:
    """Paths and sizes of the archive files below a folder; file bytes are read only `with_bytes`.

    Spark packs small files into one task by size and gives a large file a task of its own.
    """
    columns = ["path", "length", "content"] if with_bytes else ["path", "length"]
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", ARCHIVE_FILES)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(*columns)
    )


def read_records_of(
    spark: SparkSession,
    path: str,
    max_bytes: int | None = None,
    version: str = "WARC/",
    with_bytes: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """Raw records of every archive below a folder.

    `with_bytes` lets Spark's own file systems read whole files (below 2 GiB each) instead of Arrow's
    streaming them, for clusters where Arrow has no client for the storage. With `split_bytes`, a compressed
    archive is read by as many tasks as it has splits of that size.
    """
    if split_bytes is None:
        return decode_files(archive_files(spark, path, with_bytes), max_bytes, version)
    if with_bytes:
        raise ValueError("splits are read from the storage, not from bytes at hand")
    splits = archive_splits(archive_files(spark, path), split_bytes)
    size = splits.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0))).first()[0]
    return decode_splits(splits.repartition(max(1, -(-size // split_bytes))), max_bytes, version)


def to_captures(records: DataFrame) -> DataFrame:
    """Captures of raw records: HTTP message split, key and time added.

    An ARC record's type is its header field; a WARC record's is its HTTP Content-Type, null without one.
    The digest of the content is stored with it, so that duplicates are found without reading it again.
    """
    parsed = parse_http(records)
    http_type = F.element_at("http_headers", F.lit("content-type"))
    body = F.octet_length("content")
    return parsed.select(
        "url",
        url_key("url").alias("url_key"),
        capture_ts("capture_date").alias("capture_ts"),
        "capture_date",
        F.when(F.col("format") == "warc", http_type).otherwise(F.col("content_type")).alias("content_type"),
        "record_type",
        "content",
        F.coalesce(body, F.col("payload_length")).cast("long").alias("content_length"),
        F.sha2("content", 256).alias("content_sha"),
        "ip",
        "http_status",
        "http_headers",
        "headers",
        "source_file",
        "source_offset",
        "error",
    ).select(*CAPTURES.names)


def read_archives(spark: SparkSession, path: str, max_bytes: int | None = None, split_bytes: int | None = None) -> DataFrame:
    """Captures of every ARC and WARC file below a folder, told apart by content."""
    return to_captures(read_records_of(spark, path, max_bytes, split_bytes=split_bytes))


def read_arc(spark: SparkSession, path: str, max_bytes: int | None = None, split_bytes: int | None = None) -> DataFrame:
    """Captures of the ARC files below a folder."""
    return to_captures(read_records_of(spark, path, max_bytes, split_bytes=split_bytes).filter(F.col("format") == "arc"))


def read_warc(spark: SparkSession, path: str, max_bytes: int | None = None, split_bytes: int | None = None) -> DataFrame:
    """Captures of the WARC files below a folder, every record type."""
    return to_captures(read_records_of(spark, path, max_bytes, split_bytes=split_bytes).filter(F.col("format") == "warc"))


def read_clueweb(spark: SparkSession, path: str, max_bytes: int | None = None, version: str = "WARC/0.18") -> DataFrame:
    """Records of WARC/0.18 files with their document id, other headers kept in the map."""
    return clueweb_documents(read_records_of(spark, path, max_bytes, version).filter(F.col("format") == "warc"))


def clueweb_documents(records: DataFrame) -> DataFrame:
    """(docid, record_type, capture_date, url, headers, content, display_type) of WARC/0.18 records.

    Content is the text after the line that holds the HTTP Content-Length.
    """
    from crawlstrata.functions.content import utf8

    text = utf8("payload")
    named = F.greatest(F.instr("_text", "Content-Length:"), F.lit(1))
    line_end = F.locate("\n", F.substr("_text", named))
    start = F.when(line_end > 0, named + line_end).otherwise(1)
    return records.withColumn("_text", text).select(
        F.element_at("headers", F.lit("WARC-TREC-ID")).alias("docid"),
        "record_type",
        "capture_date",
        "url",
        "headers",
        F.substr("_text", start).alias("content"),
        F.lit("text/html").alias("display_type"),
        "source_file",
        "source_offset",
    )
