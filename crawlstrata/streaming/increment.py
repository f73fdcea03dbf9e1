"""Incremental loading of newly arrived archive files."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from crawlstrata.operators.ingest import append_load
from crawlstrata.sources.archives import ARCHIVE_FILES, decode_files, to_captures

# An age no file reaches (Spark leaves out older ones), and the columns of Spark's binary file source.
NEVER_TOO_OLD = "100000d"
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def ingest_increment(
    spark: SparkSession,
    path: str,
    table: str,
    checkpoint: str,
    max_bytes: int | None = None,
    files_per_batch: int = 1000,
    with_bytes: bool = False,
) -> StreamingQuery:
    """Append the captures of archive files that arrived since the last run, then stop.

    The stream's checkpoint remembers which files were loaded, however old they are. A batch is a load of
    the table named after the stream and its number, so one repeated after a failure replaces itself. Only
    paths travel through the stream; tasks open the files themselves, or Spark's own file systems read them whole
    `with_bytes`, where Arrow has no client for the storage.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def append(batch: DataFrame, batch_id: int) -> None:
        append_load(to_captures(decode_files(batch, max_bytes)), table, max_bytes, f"{stream}-{batch_id}")

    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", ARCHIVE_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", NEVER_TOO_OLD)
        .load(path)
        .select("path", *(["content"] if with_bytes else []))
    )
    return (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
