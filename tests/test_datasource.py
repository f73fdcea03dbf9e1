"""The archive data source beside the readers that it shares."""

import pytest
from archive_files import arc_file, arc_record, http, members, warc_record
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crawlstrata.sources import archives, datasource

DATE = "20040124034300"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("source")
    (path / "a.arc.gz").write_bytes(arc_file([arc_record(f"http://a.com/{i}", DATE, "text/html", http(b"x" * i * 50)) for i in range(200)]))
    records = [
        warc_record(kind, [("WARC-Target-URI", f"http://b.com/{i}"), ("WARC-Date", "2013-02-27T15:01:31Z")], http(bytes([i % 256]) * 3000))
        for i in range(300) for kind in ("response", "request")
    ]
    (path / "b #1 50%.warc.gz").write_bytes(members([*records, warc_record("warcinfo", [], b"about")]))
    (path / "sub").mkdir()
    (path / "sub" / "c.warc").write_bytes(members([*records[:20], b"stray\r\n", *records[20:40]], False))
    (path / "broken.arc").write_bytes(b"nothing known")
    (path / "_hidden.arc").write_bytes(b"nothing known")
    (path / "empty.warc.gz").write_bytes(b"")
    (path / "other.txt").write_bytes(b"x")
    return str(path)


def load(spark, folder, schema=None, **options):
    reader = datasource.register(spark).read.format(datasource.FORMAT).options(**options)
    return (reader.schema(schema) if schema else reader).load(folder)


def digests(records, *columns):
    shown = [F.to_json(F.array_sort(F.map_entries("headers"))) if c == "headers" else F.md5("payload") if c == "payload" else F.col(c) for c in columns]
    return sorted(map(tuple, records.select(F.regexp_extract("source_file", "[^/]*$", 0), *shown).collect()), key=repr)


COLUMNS = ["format", "record_type", "url", "ip", "capture_date", "content_type", "payload_length", "headers", "payload", "error"]


@pytest.mark.parametrize("split_bytes", [2_000, 20_000, 1 << 27])
def test_records_are_those_of_the_readers(spark, folder, split_bytes):
    found = load(spark, folder, splitBytes=split_bytes)
    assert digests(found, *COLUMNS) == digests(archives.read_records_of(spark, folder), *COLUMNS)
    named = found.filter(F.col("url").startswith("http://b.com/") & F.col("source_file").endswith(".warc.gz"))
    assert named.count() == 600 == named.select("source_file", "source_offset").distinct().count()
    assert found.filter("record_type = 'warcinfo'").count() == 1
    assert (found.rdd.getNumPartitions() > 4) == (split_bytes < 1 << 20)


def test_files_with_odd_names_are_read_from_the_storage(spark, folder):
    found = load(spark, folder, files="b *.warc.gz")
    assert found.count() == 601 and {r.source_file.rsplit("/", 1)[1] for r in found.collect()} == {"b #1 50%.warc.gz"}


def test_payloads_are_kept_only_where_asked_for(spark, folder):
    whole = load(spark, folder)
    narrow = load(spark, folder, "url string, payload_length long, error string")
    assert narrow.columns == ["url", "payload_length", "error"]
    assert sorted(map(tuple, narrow.collect()), key=repr) == sorted(map(tuple, whole.select(*narrow.columns).collect()), key=repr)
    limited = load(spark, folder, maxBytes=3000)
    kept = {(r.url, r.payload is not None) for r in limited.filter("url like 'http://a.com/%'").collect()}
    assert kept == {(f"http://a.com/{i}", i * 50 <= 3000) for i in range(200)}


@pytest.mark.parametrize("condition", [
    "record_type = 'response'", "record_type IN ('request', 'x')", "url LIKE 'http://a.com/1%'", "url LIKE '%9'", "url LIKE '%b.com%'",
    "url IS NULL", "url IS NOT NULL AND payload_length > 3000", "NOT (record_type = 'response')", "record_type <=> NULL",
    "record_type = 'response' AND url LIKE '%7'", "record_type = 'response' OR url LIKE '%7'", "source_file LIKE '%.warc'",
    "capture_date = '20040124034300'", "headers['WARC-Type'] = 'request'", "record_type = 'none'",
])
def test_filters_keep_their_rows(spark, folder, condition):
    got = digests(load(spark, folder, splitBytes=20_000).filter(condition), *COLUMNS)
    frame = spark.createDataFrame(load(spark, folder, splitBytes=20_000).collect(), datasource.RECORDS)
    assert got == digests(frame.filter(condition), *COLUMNS)


def test_filters_reach_the_reader():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    reader = datasource.ArchiveReader(datasource.RECORDS, {"path": "x"})
    left = [GreaterThan(("payload_length",), 5), EqualTo(("headers", "a"), "b"), EqualTo(("ip",), "1")]
    taken = [EqualTo(("record_type",), "response"), In(("url",), ("a", None)), StringStartsWith(("source_file",), "file:/a")]
    assert list(reader.pushFilters(left[:1] + taken + left[1:])) == left
    assert reader._wants({"record_type": "response", "url": "a"}) and not reader._wants({"record_type": "response", "url": None})
    assert reader._wants_file("file:/a/b") and not reader._wants_file("file:/b")


def test_payloads_of_unwanted_records_are_passed_over():
    import io

    from crawlstrata.sources.records import read_records

    data = members([warc_record(k, [("WARC-Target-URI", "http://a.com/")], b"p" * 9) for k in ("request", "response", "request")])
    rows = list(read_records(io.BytesIO(data), "f", wants=lambda row: row["record_type"] == "response"))
    assert [(r["payload"], r["payload_length"], r["error"]) for r in rows] == [(None, 9, None), (b"p" * 9, 9, None), (None, 9, None)]


def test_partitions_hold_what_their_size_allows(folder):
    parts = datasource.ArchiveReader(datasource.RECORDS, {"path": folder}).partitions()
    assert len(parts) == 1 and len(parts[0].splits) == 5
    cut = datasource.ArchiveReader(datasource.RECORDS, {"path": folder, "splitBytes": "5000"})
    spans = [s for p in cut.partitions() for s in p.splits if " " in s[0]]
    assert len(spans) > 2 and [s[1] for s in spans[1:]] == [s[2] for s in spans[:-1]] and [s[3] for s in spans] == list(range(len(spans)))
    assert len(datasource.ArchiveReader(datasource.RECORDS, {"path": folder + "/a.arc.gz"}).partitions()) == 1


def test_no_archives_and_wrong_requests(spark, tmp_path):
    assert load(spark, str(tmp_path)).count() == 0
    with pytest.raises(PySparkException, match="no such columns"):
        load(spark, str(tmp_path), "url long").count()
    with pytest.raises(PySparkException, match="FileNotFoundError"):
        load(spark, str(tmp_path / "none")).count()
