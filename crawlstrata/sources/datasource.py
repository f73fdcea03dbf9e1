"""ARC and WARC files as a Spark data source: `spark.read.format("webarchive").load(path)`.

`register(spark)` makes the format known. Its columns are those of `schema.RECORDS`; a table schema with fewer of them
(`spark.read.schema("url string, capture_date string")`) reads only these, and without `payload` no payload is held or sent.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from crawlstrata.schema import RECORDS
from crawlstrata.sources.archives import ARROW_RECORDS, SPLIT_BYTES, batches_of, file_system, rows_of_file, rows_of_split

FORMAT = "webarchive"
# Columns that are known before a record's payload is read, and what an archive's name ends with.
HEAD_COLUMNS = frozenset(("source_file", "record_type", "url", "capture_date"))
ENDINGS = (".arc", ".warc", ".arc.gz", ".warc.gz")
# What opening one more file costs, in bytes, where small files share a task.
OPEN_COST = 4 << 20
# No payload is kept under this limit.
NOTHING = -1

Test = Callable[[str], bool]


@dataclass
class Part(InputPartition):
    """What one task reads: (path, first byte, end, number of the split), a whole file where the number is None."""

    splits: list[tuple[str, int, int, int | None]]


def test_of(wanted: Filter) -> tuple[str, Test] | None:
    """The column of a filter that can be told from a record's head, and its test on a value that is not null."""
    column = getattr(wanted, "attribute", ())  # a negation has none of its own
    if len(column) != 1 or column[0] not in HEAD_COLUMNS:
        return None
    test: Test
    match wanted:
        case EqualTo(value=value):
            test = lambda found: found == value
        case In(value=values):
            held = frozenset(v for v in values if v is not None)
            test = lambda found: found in held
        case IsNotNull():
            test = lambda found: True
        case StringStartsWith(value=value):
            test = lambda found: found.startswith(value)
        case StringEndsWith(value=value):
            test = lambda found: found.endswith(value)
        case StringContains(value=value):
            test = lambda found: value in found
        case _:
            return None
    return column[0], test


def archives_below(path: str) -> Iterator[tuple[str, int]]:
    """(URI, bytes) of the archive files below a folder, or of the one file; hidden files and folders are left out."""
    system, root = file_system(path)
    root = root.rstrip("/")
    local = isinstance(system, fs.LocalFileSystem)
    prefix = "" if local else path.rstrip("/").removesuffix(root)
    top = system.get_file_info(root)
    if top.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [top] if top.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    for info in sorted(found, key=lambda info: info.path):
        inner = info.path[len(root) :].split("/")
        if info.type == fs.FileType.File and info.path.endswith(ENDINGS) and not any(p.startswith(("_", ".")) for p in inner):
            yield ("file:" + info.path if local else prefix + info.path), info.size


class ArchiveReader(DataSourceReader):
    """Reads the archives in splits of like sizes; compressed files are cut, small ones share a task."""

    def __init__(self, schema: StructType, options):
        unknown = [f.name for f in schema.fields if f.name not in RECORDS.names or f.dataType != RECORDS[f.name].dataType]
        if unknown:
            raise ValueError(f"no such columns of an archive: {', '.join(unknown)}")
        if "path" not in options:
            raise ValueError("name a folder or a file to load")
        self.path, self.files = options["path"], options.get("files")
        self.names = schema.names
        self.version = options.get("version", "WARC/").encode()
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.limit = int(options["maxBytes"]) if "maxBytes" in options else None
        if self.split_bytes < 1:
            raise ValueError("splitBytes must be positive")
        if "payload" not in self.names:
            self.limit = NOTHING
        self.tests: list[tuple[str, Test]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for wanted in filters:
            told = test_of(wanted)
            if told is None:
                yield wanted
            else:
                self.tests.append(told)

    def partitions(self) -> list[Part]:
        """One per split of a large file, and one per group of small ones; files that no filter wants are not opened."""
        parts: list[Part] = []
        held: list[tuple[str, int, int, int | None]] = []
        size = 0
        for path, length in archives_below(self.path):
            if self.files and not fnmatch.fnmatchcase(path.rsplit("/", 1)[1], self.files):
                continue
            if not self._wants_file(path):
                continue
            if path.endswith(".gz") and length > self.split_bytes:
                starts = range(0, length, self.split_bytes)
                parts += [Part([(path, at, min(at + self.split_bytes, length), n)]) for n, at in enumerate(starts)]
                continue
            if held and size + length > self.split_bytes:
                parts.append(Part(held))
                held, size = [], 0
            held.append((path, 0, length, None))
            size += length + OPEN_COST
        return parts + [Part(held)] if held or not parts else parts

    def _wants_file(self, path: str) -> bool:
        return all(test(path) for column, test in self.tests if column == "source_file")

    def _wants(self, row: dict) -> bool:
        return all(row[column] is not None and test(row[column]) for column, test in self.tests if column != "source_file")

    def read(self, partition: Part):
        wants = self._wants if any(column != "source_file" for column, _ in self.tests) else None

        def rows():
            for path, start, end, number in partition.splits:
                if number is None:
                    found = rows_of_file(path, self.limit, self.version, wants)
                else:
                    found = rows_of_split(path, start, end, number, self.limit, self.version, wants)
                yield from found if wants is None else (row for row in found if wants(row))

        at = [ARROW_RECORDS.get_field_index(name) for name in self.names]
        for batch in batches_of(rows()):
            yield batch.select(at)


class WebArchive(DataSource):
    """Records of ARC and WARC files below a path, as `read_records_of` reads them.

    Options: `splitBytes`, the bytes of a compressed file that one task reads; `maxBytes`, the largest body that is kept;
    `version`, how the records of a WARC file begin; `files`, a pattern for the files' names.
    Filters on `source_file`, `record_type`, `url` and `capture_date` (equality, lists, not null, parts of the text) are taken over:
    a file that no filter wants is not opened, and the payload of a record that none wants is passed over.
    `source_offset` counts from the split's own place in the file, as in `archives.decode_splits`.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return RECORDS

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(schema, self.options)


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to the session, and let Spark hand over filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WebArchive)
    return spark
