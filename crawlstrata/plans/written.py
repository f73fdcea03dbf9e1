"""Archive files made from the given tables, for the queries that load files."""

from __future__ import annotations

import gzip

from pyspark import TaskContext
from pyspark.sql import DataFrame

# The record an ARC file begins with.
ARC_BLOCK = "1 0 test\nURL IP-address Archive-date Content-type Archive-length\n"
ARC_HEAD = f"filedesc://x.arc 0.0.0.0 20240101000000 text/plain {len(ARC_BLOCK)}\n{ARC_BLOCK}\n"


def _writer(folder: str, name: str, head: bytes, kind: str):
    from crawlstrata.sources.archives import file_system

    def write(batches):
        system, inside = file_system(folder)
        system.create_dir(inside, recursive=True)
        task, written = TaskContext.get(), 0
        member = (lambda data: gzip.compress(data, mtime=0)) if kind.endswith(".gz") else (lambda data: data)
        # Under the attempt's own name until it is whole: attempts at one task never write into one file.
        attempt = f"{inside}/.{name}-{task.taskAttemptId()}"
        with system.open_output_stream(attempt, compression=None) as out:
            if head:
                out.write(member(head))
            for batch in batches:
                for record in batch.column(0):
                    out.write(member(record.as_py()))
                    written += 1
        system.move(attempt, f"{inside}/{name}-{task.partitionId()}.{kind}")
        yield _count(written)

    return write


def _count(written: int):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"written": [written]}, schema=pa.schema([("written", pa.int64())]))


def write_archives(records: DataFrame, folder: str, name: str, kind: str = "arc") -> None:
    """Write the records as one file per task, ARC or WARC by `kind`; a repeated task replaces its file."""
    head = ARC_HEAD.encode() if kind.startswith("arc") else b""
    records.mapInArrow(_writer(folder, name, head, kind), "written long").write.format("noop").mode("overwrite").save()
