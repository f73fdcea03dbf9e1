"""Queries over the given tables, each with its DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crawlstrata.functions import content as C
from crawlstrata.functions import dates as D
from crawlstrata.functions import keys as K
from crawlstrata.functions.register import register_functions, register_site_codes
from crawlstrata.operators.numbering import running_totals
from crawlstrata.operators import counts, graph, ingest, outlinks, search, text, urlids, versions
from crawlstrata.plans.views import (
    CAPTURES_SQL,
    HOST_SQL,
    STAMP_SQL,
    capture_index,
    captures,
    key_sql,
    page_captures,
    stamp,
    table,
)
from crawlstrata.plans.written import ARC_HEAD, write_archives
from crawlstrata.session import cut_lineage, scratch
from crawlstrata.sources import archives, datasource, sinks, textfiles
from crawlstrata.streaming.increment import ingest_increment as load_increment

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEY = key_sql("url")


def query(oracle: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return add


def over_captures(select: str, more: str = "") -> str:
    return f"WITH {CAPTURES_SQL}{', ' + more if more else ''} {select}"


# Column expressions


@query(f"SELECT page_id, {KEY} AS url_key FROM pages")
def url_key(spark, d):
    return table(spark, d, "pages").select("page_id", K.url_key("url").alias("url_key"))


@query(f"SELECT page_id, 'http://' || {HOST_SQL.format('url')} AS host FROM pages")
def key_to_host(spark, d):
    return table(spark, d, "pages").select("page_id", K.key_to_host(K.url_key("url")).alias("host"))


@query("SELECT page_id, 'http://' || regexp_extract(url, '^https?://([^#]*)', 1) AS url FROM pages")
def key_to_url(spark, d):
    return table(spark, d, "pages").select("page_id", K.key_to_url(K.url_key("url")).alias("url"))


@query(f"SELECT page_id, split_part({KEY}, '/', 1) AS domain FROM pages")
def key_domain(spark, d):
    return table(spark, d, "pages").select("page_id", K.key_domain(K.url_key("url")).alias("domain"))


@query(f"""
WITH names AS (SELECT page_id, rtrim(regexp_extract({KEY}, '([^/]*)$', 1), '.') AS name FROM pages)
SELECT page_id, CASE WHEN name NOT LIKE '%.%' THEN ''
  WHEN length(regexp_extract(name, '([^.]*)$', 1)) > 8 THEN ''
  WHEN regexp_matches(name, '[.][0-9]$') THEN ''
  ELSE regexp_extract(name, '([^.]*)$', 1) END AS file_type FROM names""")
def file_type(spark, d):
    return table(spark, d, "pages").select("page_id", K.file_type(K.url_key("url")).alias("file_type"))


@query(f"SELECT page_id, regexp_replace({HOST_SQL.format('url')}, '^www[.]', '') AS host FROM pages")
def host_name(spark, d):
    register_functions(table(spark, d, "pages").sparkSession)
    table(spark, d, "pages").createOrReplaceTempView("pages_to_name")
    return spark.sql("SELECT page_id, host_name(url) AS host FROM pages_to_name")


@query(f"SELECT page_id, string_split(lower({HOST_SQL.format('url')}), '.')[-2] AS label FROM pages")
def site_label(spark, d):
    return table(spark, d, "pages").select("page_id", K.site_label("url").alias("label"))


@query(over_captures("""
SELECT source_offset, u.unit, CASE u.unit WHEN 'year' THEN substr(capture_date, 1, 4)
  WHEN 'month' THEN substr(capture_date, 5, 2) WHEN 'day' THEN substr(capture_date, 7, 2) ELSE capture_date END AS part
FROM caps CROSS JOIN (VALUES ('year'), ('month'), ('day'), ('second')) u(unit)"""))
def date_unit(spark, d):
    register_functions(spark)
    units = F.array(*map(F.lit, ["year", "month", "day", "second"]))
    rows = capture_index(spark, d).select("source_offset", "capture_date", F.explode(units).alias("unit"))
    return rows.select("source_offset", "unit", F.expr("date_unit(capture_date, unit)").alias("part"))


@query(over_captures("SELECT source_offset, substr(capture_date, 1, 8) AS day FROM caps"))
def capture_day(spark, d):
    return capture_index(spark, d).select("source_offset", D.capture_day("capture_date").alias("day"))


@query(over_captures(
    "SELECT source_offset, strftime(capture_ts, '%Y-%m-%dT%H:%M:%S') AS seen, epoch_us(capture_ts) // 1000000 AS seconds FROM caps"
))
def capture_ts(spark, d):
    index = capture_index(spark, d)
    iso = F.date_format("capture_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    written = F.when(F.col("record_type") == "request", iso).otherwise(F.col("capture_date"))
    read = D.capture_ts(written)
    return index.select(
        "source_offset", F.date_format(read, "yyyy-MM-dd'T'HH:mm:ss").alias("seen"), F.unix_seconds(read).alias("seconds")
    )


@query(over_captures("SELECT source_offset, md5(content) AS hash, capture_date || sha1(url_key) || '.txt' AS file_name FROM caps"))
def content_hash(spark, d):
    return captures(spark, d).select(
        "source_offset", C.content_hash("content").alias("hash"), C.key_file_name("capture_date", "url_key").alias("file_name")
    )


@query("""
SELECT doc_id, regexp_replace(regexp_replace(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '[ \\t\\n\\v\\f\\r]+', ' ', 'g'),
  '[^ A-Za-z,'']+', '', 'g') AS anchor FROM documents""")
def clean_anchor(spark, d):
    return table(spark, d, "documents").select("doc_id", C.clean_anchor("text").alias("anchor"))


BASE_SQL = """CASE WHEN regexp_matches({0}, '^[^/]*/*$') THEN split_part({0}, '/', 1)
  ELSE regexp_extract({0}, '^[^/]*/[^/]*') END"""


@query(f"SELECT page_id, {BASE_SQL.format('(' + KEY + ')')} AS base FROM pages")
def base_path(spark, d):
    return table(spark, d, "pages").select("page_id", K.base_path(K.url_key("url")).alias("base"))


# Sources and sinks


def _crlf(*lines) -> F.Column:
    return F.concat(*[part for line in lines for part in (line, F.lit("\r\n"))])


def _http(status: str, body) -> F.Column:
    head = _crlf(F.lit(f"HTTP/1.1 {status}"), F.lit("Content-Type: text/html; charset=utf-8"), F.lit("Server: test"))
    return F.concat(head.cast("binary"), F.lit("\r\n").cast("binary"), body)


def _arc_record() -> F.Column:
    """One page as an ARC record."""
    message = _http("200 OK", F.col("content"))
    line = F.concat_ws(" ", "url", F.lit("10.0.0.1"), "capture_date", F.lit("text/html"), F.octet_length(message))
    return F.concat(line.cast("binary"), F.lit("\n").cast("binary"), message, F.lit("\n").cast("binary"))


def _arc_bytes() -> F.Column:
    """An ARC file that holds one page."""
    return F.concat(F.lit(ARC_HEAD).cast("binary"), _arc_record())


def _warc_record(version: str, kind, body, *fields) -> F.Column:
    named = [F.concat(F.lit(name + ": "), value) for name, value in fields]
    head = _crlf(
        F.lit(version), F.concat(F.lit("WARC-Type: "), kind), *named,
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    return F.concat(head.cast("binary"), F.lit("\r\n").cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def _warc_bytes(pages: DataFrame) -> F.Column:
    """A WARC file with a page's request and response."""
    iso = F.date_format("capture_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    about = [("WARC-Target-URI", F.col("url")), ("WARC-Date", iso)]
    kind = ("Content-Type", F.lit("application/http; msgtype=response"))
    asked = F.lit("GET / HTTP/1.1\r\n\r\n").cast("binary")
    return F.concat(
        _warc_record("WARC/1.0", F.lit("request"), asked, *about, kind),
        _warc_record("WARC/1.0", F.lit("response"), _http("200 OK", F.col("content")), *about, kind),
    )


def _files(pages: DataFrame, content) -> DataFrame:
    return pages.select(F.concat(F.lit("page-"), "source_offset").alias("path"), content.alias("content"))


ARCHIVED = ["source_file", "url", "url_key", "capture_date", "content_type", "http_status", "record_type", "content_length"]


def _archived(records: DataFrame) -> DataFrame:
    return archives.to_captures(records).select(*ARCHIVED, C.content_hash("content").alias("hash"))


PAGE_STAMP = "strftime(epoch_ms((1704067200 + page_id) * 1000), '{0}')"
ARC_SQL = f"""SELECT 'page-' || page_id AS source_file, url, {KEY} AS url_key, {PAGE_STAMP.format('%Y%m%d%H%M%S')} AS capture_date,
  'text/html' AS content_type, 200 AS http_status, 'response' AS record_type, CAST(strlen(html) AS BIGINT) AS content_length,
  md5(html) AS hash FROM pages"""
WARC_SQL = f"""SELECT 'page-' || page_id AS source_file, url, {KEY} AS url_key, {PAGE_STAMP.format('%Y-%m-%dT%H:%M:%SZ')} AS capture_date,
  'text/html; charset=utf-8' AS content_type, 200 AS http_status, 'response' AS record_type,
  CAST(strlen(html) AS BIGINT) AS content_length, md5(html) AS hash FROM pages"""
WARC_REQUEST_SQL = f"""SELECT 'page-' || page_id, url, {KEY}, {PAGE_STAMP.format('%Y-%m-%dT%H:%M:%SZ')}, NULL, -1, 'request',
  18, md5('GET / HTTP/1.1' || chr(13) || chr(10) || chr(13) || chr(10)) FROM pages"""


@query(ARC_SQL)
def read_arc(spark, d):
    pages = page_captures(spark, d)
    return _archived(archives.decode_files(_files(pages, _arc_bytes()))).filter("record_type = 'response'")


@query(f"{WARC_SQL} UNION ALL {WARC_REQUEST_SQL}")
def read_warc(spark, d):
    pages = page_captures(spark, d)
    return _archived(archives.decode_files(_files(pages, _warc_bytes(pages))))


@query(f"{ARC_SQL} WHERE url LIKE 'http:%' UNION ALL {WARC_SQL} WHERE url LIKE 'https:%'")
def format_dispatch(spark, d):
    pages = page_captures(spark, d)
    either = F.when(F.col("url").startswith("http:"), _arc_bytes()).otherwise(_warc_bytes(pages))
    return _archived(archives.decode_files(_files(pages, either))).filter("record_type = 'response'")


@query("""SELECT 'doc-' || doc_id AS docid, 'response' AS record_type, 'http://' || source || '.example.com/' AS url,
  chr(10) || text AS content, 'text/html' AS display_type FROM documents""")
def read_clueweb(spark, d):
    documents = table(spark, d, "documents")
    body = F.concat(F.lit("HTTP/1.1 200 OK\nContent-Length: "), F.octet_length("text"), F.lit("\n\n"), "text")
    record = _warc_record(
        "WARC/0.18", F.lit("response"), body.cast("binary"),
        ("WARC-Target-URI", F.concat(F.lit("http://"), "source", F.lit(".example.com/"))),
        ("WARC-TREC-ID", F.concat(F.lit("doc-"), "doc_id")),
    )
    files = documents.select(F.concat(F.lit("doc-"), "doc_id").alias("path"), record.alias("content"))
    found = archives.clueweb_documents(archives.decode_files(files, version="WARC/0.18"))
    return found.select("docid", "record_type", "url", "content", "display_type")


@query("""SELECT page_id, CASE WHEN url LIKE 'https:%' THEN 200 ELSE 404 END AS http_status,
  'text/html; charset=utf-8' AS content_type, 'test' AS server, md5(html) AS hash FROM pages""")
def parse_http(spark, d):
    pages = page_captures(spark, d)
    status = F.when(F.col("url").startswith("https:"), _http("200 OK", F.col("content"))).otherwise(
        _http("404 Not Found", F.col("content"))
    )
    raw = pages.select(F.col("source_offset").alias("page_id"), "url", status.alias("payload"))
    return C.parse_http(raw).select(
        "page_id",
        "http_status",
        F.element_at("http_headers", F.lit("content-type")).alias("content_type"),
        F.element_at("http_headers", F.lit("server")).alias("server"),
        C.content_hash("content").alias("hash"),
    )


@query("SELECT page_id, md5(html) AS hash, CAST(length(html) AS BIGINT) AS characters FROM pages")
def html_text_decode(spark, d):
    wide = F.col("url").startswith("http:")
    named = F.when(wide, "text/html; charset=utf-16be").otherwise("text/html; charset=utf-8")
    pages = table(spark, d, "pages").select(
        "page_id",
        F.lit("text/html").alias("content_type"),
        F.create_map(F.lit("content-type"), named).alias("http_headers"),
        F.when(wide, F.encode("html", "UTF-16BE")).otherwise(F.encode("html", "UTF-8")).alias("content"),
    )
    decoded = C.html_text_decode(pages)
    return decoded.select("page_id", F.md5(F.col("text").cast("binary")).alias("hash"), F.length("text").cast("long").alias("characters"))


@query("SELECT url FROM pages")
def url_list(spark, d):
    lines = table(spark, d, "pages").select(F.concat_ws(" ", "url", F.lit("text/html\t"), "page_id").alias("value"))
    return textfiles.parse_url_list(lines)


@query("""
WITH lists AS (SELECT user_id, event_id, [event_id, event_id % 97, user_id] AS dst FROM events)
SELECT user_id AS src, array_to_string(arg_max(dst, event_id), ',') AS dst FROM lists GROUP BY user_id""")
def adjacency_lines_read(spark, d):
    lines = table(spark, d, "events").select(
        F.concat(
            F.col("user_id").cast("string"), F.lit("\t["), F.col("event_id").cast("string"), F.lit(", "),
            (F.col("event_id") % 97).cast("string"), F.lit(", "), F.col("user_id").cast("string"), F.lit("]"),
        ).alias("value"),
        F.col("event_id").alias("line_no"),
    )
    return textfiles.parse_adjacency(lines).select("src", F.array_join("dst", ",").alias("dst"))


@query("SELECT DISTINCT lang AS site_id FROM documents WHERE lang <> 'go'")
def site_ids_read(spark, d):
    return textfiles.parse_site_ids(table(spark, d, "documents").select(F.col("lang").alias("value")))


SEEDS_SQL = f"""seeds AS (SELECT DISTINCT substr({HOST_SQL.format('url')}, 6) AS host FROM pages
  WHERE {HOST_SQL.format('url')} LIKE 'blog.%')"""
META_SQL = f"""meta AS (SELECT regexp_extract(url, '^https?://[^/?#]*/([a-z]+)/', 1) AS code, url, page_id AS line_no FROM pages)"""


def _seeds(spark, d) -> DataFrame:
    """The domain above every blog host."""
    host = K.url_host("url")
    blogs = table(spark, d, "pages").filter(host.startswith("blog.")).select(F.substr(host, F.lit(6)).alias("value"))
    return textfiles.parse_seeds(blogs)


def _meta(spark, d) -> DataFrame:
    """A site table: the language folder of each page as the code of its URL."""
    code = F.regexp_extract("url", "^https?://[^/?#]*/([a-z]+)/", 1)
    lines = table(spark, d, "pages").select(
        F.concat_ws("\t", code, F.lit("a"), F.lit("b"), "url", F.lit("2009-03-01 10:00")).alias("value"),
        F.col("page_id").alias("line_no"),
    )
    return textfiles.parse_site_meta(lines)


@query(f"WITH {SEEDS_SQL} SELECT host FROM seeds")
def seeds_read(spark, d):
    return _seeds(spark, d)


@query(f"WITH {META_SQL} SELECT code, url, '20090301' AS approved, line_no FROM meta")
def site_meta_read(spark, d):
    return _meta(spark, d)


# Loading


LOADABLE_SQL = """loaded AS (SELECT source_file, source_offset, url_key, coalesce(content_type, 'text/plain') AS content_type,
  date_trunc('day', capture_ts) AS day, content, content_length FROM caps
  WHERE record_type = 'response')"""
WRITTEN_SQL = """SELECT source_file, source_offset, url_key, content_type, strftime(day, '%Y%m%d%H%M%S') AS capture_date, content_length
  FROM loaded QUALIFY row_number() OVER (PARTITION BY url_key, content_type, day ORDER BY source_file DESC, source_offset DESC) = 1"""


def _daily(rows: DataFrame) -> DataFrame:
    """Captures timed by the day, so that a page is captured more than once at one time."""
    return rows.withColumn("capture_ts", F.date_trunc("day", "capture_ts"))


@query(over_captures(WRITTEN_SQL, LOADABLE_SQL))
def ingest_rows(spark, d):
    kept = ingest.one_per_identity(ingest.loadable(_daily(captures(spark, d))))
    return kept.select(
        "source_file", "source_offset", "url_key", "content_type", stamp("capture_ts").alias("capture_date"), "content_length"
    )


@query(over_captures("""
SELECT CASE WHEN record_type <> 'response' THEN 'not_response' WHEN content_length > 4096 THEN 'too_large' ELSE 'inserted' END
  AS reason, count(*) AS records FROM caps GROUP BY 1"""))
def ingest_report(spark, d):
    return ingest.ingest_report(captures(spark, d), max_bytes=4096)


@query(over_captures(WRITTEN_SQL, LOADABLE_SQL))
def bulk_load_rows(spark, d):
    path = scratch(spark, "bulk")
    ingest.bulk_load(_daily(captures(spark, d)), path)
    kept = ingest.read_table(spark, path)
    return kept.select(
        "source_file", "source_offset", "url_key", "content_type", stamp("capture_ts").alias("capture_date"), "content_length"
    )


@query(f"""SELECT url_key, 'text/html' AS content_type, capture_date, content_length, hash FROM
  (SELECT {KEY} AS url_key, {PAGE_STAMP.format('%Y%m%d%H%M%S')} AS capture_date, CAST(strlen(html) AS BIGINT) AS content_length,
     md5(html) AS hash FROM pages)""")
def ingest_increment(spark, d):
    """Pages arrive as ARC files in two parts; each is loaded as it comes."""
    pages = page_captures(spark, d)
    folder = scratch(spark, "arrivals")
    secure = F.col("url").startswith("https:")
    for part, arrived in (("first", pages.filter(~secure)), ("second", pages.filter(secure))):
        write_archives(arrived.select(_arc_record().alias("record")), f"{folder}/files", part)
        load_increment(spark, f"{folder}/files", f"{folder}/table", f"{folder}/progress").awaitTermination()
    loaded = ingest.read_table(spark, f"{folder}/table")
    return loaded.select("url_key", "content_type", "capture_date", "content_length", C.content_hash("content").alias("hash"))


@query(f"""SELECT {KEY} AS url_key, CASE WHEN page_id % 3 = 0 THEN 'x' || md5(html) ELSE md5(html) END AS content FROM pages""")
def ingest_append(spark, d):
    """All pages loaded; then every third appended with another content, by a run that is repeated."""
    pages = page_captures(spark, d).withColumn("content", F.md5("content").cast("binary"))
    changed = pages.filter(F.col("source_offset") % 3 == 0).withColumn("content", F.concat(F.lit(b"x"), F.col("content")))
    # The changed captures come from files that sort before the others.
    changed = changed.withColumn("source_file", F.lit("again"))
    path = scratch(spark, "appended")
    ingest.ingest(pages, path, "create")
    for _ in range(2):
        ingest.ingest(changed, path, "append")
    return ingest.read_table(spark, path).select("url_key", F.col("content").cast("string").alias("content"))


@query(over_captures("""SELECT CASE WHEN length(url_key) > 1 THEN substr(url_key, 1, 1) ELSE '' END AS first_char,
  count(*) AS captures FROM caps GROUP BY 1"""))
def key_histogram(spark, d):
    return ingest.key_histogram(capture_index(spark, d))


@query(over_captures("""
SELECT CAST(before * 8 // total AS INTEGER) AS part, min(url_key) AS boundary FROM placed GROUP BY 1 HAVING part > 0""", """
counted AS (SELECT url_key, count(*) AS n FROM caps GROUP BY url_key),
placed AS (SELECT url_key, sum(n) OVER (ORDER BY url_key) - n AS before, sum(n) OVER () AS total FROM counted)"""))
def split_points(spark, d):
    return ingest.split_points(capture_index(spark, d), 8)


# Projections, filters, search


@query(over_captures("SELECT concat_ws(' ', url, content_type) AS url_type, capture_date FROM caps"))
def list_arc(spark, d):
    return search.list_arc(capture_index(spark, d))


@query(over_captures("SELECT url, capture_date FROM caps WHERE url IS NOT NULL"))
def list_warc(spark, d):
    return search.list_warc(capture_index(spark, d))


@query(over_captures("""SELECT source_file, capture_date, content_type, content_length, url_key FROM caps
  WHERE url = (SELECT min(url) FROM pages)"""))
def find_url(spark, d):
    return search.find_url(captures(spark, d), table(spark, d, "pages").agg(F.min("url")).scalar())


@query(over_captures("SELECT source_offset, url FROM caps WHERE content_type = 'text/html'"))
def html_exact(spark, d):
    return search.html_only(capture_index(spark, d)).select("source_offset", "url")


@query(over_captures("SELECT source_offset, url FROM caps WHERE content_type LIKE '%html%'"))
def html_contains(spark, d):
    return search.html_only(capture_index(spark, d), "contains").select("source_offset", "url")


@query(over_captures("SELECT DISTINCT url_key FROM caps"))
def distinct_urls(spark, d):
    return search.distinct_urls(capture_index(spark, d))


@query(over_captures(f"""SELECT source_file AS archive, count(*) AS captures, count(DISTINCT url_key) AS urls,
  {STAMP_SQL.format('min(capture_ts)')} AS first_ts, {STAMP_SQL.format('max(capture_ts)')} AS last_ts FROM caps GROUP BY 1"""))
def archive_summary(spark, d):
    named = capture_index(spark, d).withColumnRenamed("source_file", "archive")
    return search.archive_summary(named, "archive").select(
        "archive", "captures", "urls", stamp("first_ts").alias("first_ts"), stamp("last_ts").alias("last_ts")
    )


# Aggregations


@query(over_captures("SELECT record_type AS key, count(*) AS n FROM caps GROUP BY 1"))
def count_by(spark, d):
    return counts.count_by(capture_index(spark, d), F.col("record_type"))


@query(over_captures("SELECT content_type, count(*) AS n FROM caps GROUP BY 1"))
def count_content_types(spark, d):
    return counts.count_content_types(capture_index(spark, d))


@query(over_captures("SELECT substr(capture_date, 1, 8) AS day, count(*) AS n FROM caps GROUP BY 1"))
def count_crawl_dates(spark, d):
    return counts.count_crawl_dates(capture_index(spark, d))


@query(over_captures("SELECT count(*) AS total, count(*) FILTER (length(capture_date) < 8) AS errors FROM caps"))
def crawl_date_totals(spark, d):
    return counts.crawl_date_totals(capture_index(spark, d))


@query(over_captures("SELECT url, count(*) AS n FROM caps GROUP BY 1"))
def count_urls(spark, d):
    return counts.count_urls(capture_index(spark, d))


@query(over_captures("""
SELECT CASE WHEN name NOT LIKE '%.%' OR length(regexp_extract(name, '([^.]*)$', 1)) > 8 OR regexp_matches(name, '[.][0-9]$')
  THEN 'unknown' ELSE regexp_extract(name, '([^.]*)$', 1) END AS file_type, count(*) AS n
FROM (SELECT rtrim(regexp_extract(url_key, '([^/]*)$', 1), '.') AS name FROM (SELECT DISTINCT url_key FROM caps)) GROUP BY 1"""))
def count_file_types(spark, d):
    return counts.count_file_types(capture_index(spark, d))


@query(over_captures("SELECT split_part(url_key, '/', 1) AS domain, count(DISTINCT url_key) AS n FROM caps GROUP BY 1"))
def count_domains(spark, d):
    return counts.count_domains(capture_index(spark, d))


@query(over_captures("SELECT count(DISTINCT url_key) AS n FROM caps"))
def count_rows(spark, d):
    return counts.count_rows(capture_index(spark, d))


@query(over_captures(f"""
SELECT host, count(*) AS n, 'http://replay.example/crawl?query=' || host || '/' AS link
FROM (SELECT url_key, 'http://' || min({HOST_SQL.format('url')}) AS host FROM caps GROUP BY url_key) GROUP BY host"""))
def host_directory(spark, d):
    return counts.host_directory(capture_index(spark, d), "http://replay.example/", "crawl")


DUPLICATES_SQL = """
SELECT CAST(coalesce(sum(k * (k - 1) / 2), 0) AS DECIMAL(38,0)) AS duplicates,
  CAST(coalesce(sum(k * (k - 1) / 2 * size), 0) AS DECIMAL(38,0)) AS duplicate_bytes
FROM (SELECT CAST(count(*) AS HUGEINT) AS k, any_value(strlen(content)) AS size FROM {0} GROUP BY url_key, content)"""


@query(over_captures(DUPLICATES_SQL.format("caps")))
def detect_duplicates(spark, d):
    return counts.detect_duplicates(captures(spark, d))


@query(over_captures(DUPLICATES_SQL.format("newest"), """newest AS (SELECT * FROM caps QUALIFY row_number() OVER
  (PARTITION BY url_key, content_type ORDER BY capture_ts DESC, source_file DESC, source_offset DESC) = 1)"""))
def detect_duplicates_latest(spark, d):
    return counts.detect_duplicates(captures(spark, d), "latest_per_type")


@query(over_captures("""SELECT url_key, k AS copies, CAST(k * (k - 1) / 2 AS DECIMAL(38,0)) AS pairs, size AS length FROM
  (SELECT url_key, count(*) AS k, any_value(strlen(content)) AS size FROM caps GROUP BY url_key, content) WHERE k > 1"""))
def duplicate_groups(spark, d):
    return counts.duplicate_groups(captures(spark, d)).select("url_key", "copies", "pairs", "length")


SITE_IDS_SQL = """ids AS (SELECT DISTINCT regexp_extract(url, '([a-z-]+)[.]example[.]', 1) AS site_id FROM pages)"""
SITE_OF_KEY_SQL = f"""keys AS (SELECT DISTINCT {KEY} AS url_key FROM pages), {SITE_IDS_SQL},
sites AS (SELECT url_key, min(site_id) AS site_id FROM keys JOIN ids ON contains(url_key, site_id)
  WHERE site_id <> '' GROUP BY url_key HAVING count(*) = 1)"""


def _site_ids(spark, d) -> DataFrame:
    """The label before `example` in every page's host."""
    label = F.regexp_extract("url", "([a-z-]+)[.]example[.]", 1)
    return textfiles.parse_site_ids(table(spark, d, "pages").select(label.alias("value")))


@query(f"WITH {SITE_OF_KEY_SQL} SELECT site_id, {BASE_SQL.format('url_key')} AS base, count(*) AS n FROM sites GROUP BY 1, 2")
def site_base_paths(spark, d):
    return text.site_base_paths(page_captures(spark, d), _site_ids(spark, d))


@query("""SELECT CAST(event_id AS VARCHAR) || chr(9) || '[' || user_id || ', ' || event_id % 97 || ']' AS value FROM events""")
def adjacency_lines(spark, d):
    lists = table(spark, d, "events").select(
        F.col("event_id").alias("src"), F.array("user_id", F.col("event_id") % 97).alias("dst")
    )
    return sinks.adjacency_lines(lists)


@query(over_captures("SELECT split_part(url_key, '/', 1) AS domain, count(DISTINCT url_key) AS n FROM caps GROUP BY 1"))
def counts_written(spark, d):
    """Counts written as lines and read back."""
    folder = scratch(spark, "counts")
    sinks.write_counts(counts.count_domains(capture_index(spark, d)), folder)
    return spark.read.schema("domain string, n long").csv(folder, sep="\t")


@query("""SELECT user_id AS src, event_id AS dst, count(*) AS weight FROM events GROUP BY ALL""")
def site_edges_written(spark, d):
    """Edges written as Source,Target,Weight and read back."""
    edges = table(spark, d, "events").groupBy(F.col("user_id").alias("source"), F.col("event_id").alias("target"))
    folder = scratch(spark, "edges")
    sinks.write_site_edges(edges.agg(F.count(F.lit(1)).alias("weight")), folder)
    read = spark.read.schema("Source long, Target long, Weight long").csv(folder, header=True)
    return read.select(F.col("Source").alias("src"), F.col("Target").alias("dst"), F.col("Weight").alias("weight"))


@query("""SELECT event_id AS src, user_id || ',' || event_id % 97 AS dst FROM events""")
def adjacency_written(spark, d):
    """Adjacency lists written as lines and read back."""
    folder = scratch(spark, "adjacency")
    rows = table(spark, d, "events")
    sinks.write_adjacency(rows.select(F.col("event_id").alias("src"), F.array("user_id", F.col("event_id") % 97).alias("dst")), folder)
    return textfiles.read_adjacency(spark, folder).select("src", F.array_join("dst", ",").alias("dst"))


@query("SELECT page_id AS id, url AS prefix FROM pages")
def prefixes_read(spark, d):
    """Prefixes read from the lines of a file."""
    folder = scratch(spark, "prefixes")
    table(spark, d, "pages").select(F.concat_ws(",", "page_id", "url")).write.text(folder)
    return textfiles.read_prefixes(spark, folder)


@query(f"{ARC_SQL.replace(chr(39) + 'page-' + chr(39) + ' || page_id AS source_file, ', '')}")
def arc_files(spark, d):
    """Compressed ARC files of many records, written from the pages and read by path."""
    folder = scratch(spark, "arcs")
    write_archives(page_captures(spark, d).select(_arc_record().alias("record")), folder, "crawl", "arc.gz")
    read = archives.read_arc(spark, folder).filter("record_type = 'response'")
    return read.select(*ARCHIVED[1:], C.content_hash("content").alias("hash"))


@query(f"""SELECT * EXCLUDE (source_file) FROM ({WARC_SQL} UNION ALL {WARC_REQUEST_SQL})""")
def warc_files(spark, d):
    """Compressed WARC files of many records, written from the pages and read by path."""
    folder, pages = scratch(spark, "warcs"), page_captures(spark, d)
    write_archives(pages.select(_warc_bytes(pages).alias("record")), folder, "crawl", "warc.gz")
    return archives.read_warc(spark, folder).select(*ARCHIVED[1:], C.content_hash("content").alias("hash"))


# Content that one written archive holds, about: it is written by one task.
ARCHIVE_BYTES = 128 << 20


def _in_large_files(pages: DataFrame) -> DataFrame:
    """The records of the pages for one archive, or as many as hold ARCHIVE_BYTES each."""
    size = pages.agg(F.coalesce(F.sum("content_length"), F.lit(0))).first()[0]
    files = -(-size // ARCHIVE_BYTES)
    # Dealt out one by one, as parts put together may be the full ones on one side and the empty ones on the other.
    dealt = pages.repartition(files) if files > 1 else pages.coalesce(1)
    return dealt.select(_warc_bytes(dealt).alias("record"))


@query(f"""SELECT * EXCLUDE (source_file) FROM ({WARC_SQL} UNION ALL {WARC_REQUEST_SQL})""")
def warc_in_splits(spark, d):
    """All pages in one compressed WARC file (one for each 128 MB of them), read by as many tasks as it has splits of 64 KB."""
    folder = scratch(spark, "warc")
    write_archives(_in_large_files(page_captures(spark, d)), folder, "crawl", "warc.gz")
    return archives.read_warc(spark, folder, split_bytes=1 << 16).select(*ARCHIVED[1:], C.content_hash("content").alias("hash"))


def _web_archive(spark, d, large: bool = False):
    """The pages as compressed WARC files, ready to be read by format."""
    folder, pages = scratch(spark, "warc"), page_captures(spark, d)
    records = _in_large_files(pages) if large else pages.select(_warc_bytes(pages).alias("record"))
    write_archives(records, folder, "crawl", "warc.gz")
    return datasource.register(spark).read.format(datasource.FORMAT).option("path", folder)


@query(f"""SELECT * EXCLUDE (source_file) FROM ({WARC_SQL} UNION ALL {WARC_REQUEST_SQL})""")
def webarchive_captures(spark, d):
    """All pages in one compressed WARC file (one for each 128 MB of them), read through the data source in splits of 64 KB."""
    read = archives.to_captures(_web_archive(spark, d, large=True).option("splitBytes", 1 << 16).load())
    return read.select(*ARCHIVED[1:], C.content_hash("content").alias("hash"))


@query(f"""SELECT url, capture_date FROM ({WARC_SQL} UNION ALL {WARC_REQUEST_SQL})""")
def webarchive_listing(spark, d):
    """The listing through the data source, which holds and sends no payload for it."""
    return search.list_warc(_web_archive(spark, d).schema("url string, capture_date string").load())


@query(f"""SELECT url, content_length FROM ({WARC_SQL} UNION ALL {WARC_REQUEST_SQL}) WHERE record_type = 'response' AND starts_with(url, 'https:')""")
def webarchive_filtered(spark, d):
    """Filters taken over by the data source: the payloads of other records are passed over."""
    wanted = _web_archive(spark, d).load().filter((F.col("record_type") == "response") & F.col("url").startswith("https:"))
    return archives.to_captures(wanted).select("url", "content_length")


@query(over_captures("SELECT count(*) AS read, count(url) AS listed FROM caps"))
def list_warc_observed(spark, d):
    """What the listing itself says of the records that it read, in the one pass that writes it."""
    totals = Observation()
    listed = cut_lineage(search.list_warc(capture_index(spark, d), totals))
    return spark.createDataFrame([(totals.get["read"], totals.get["listed"], listed.count())], "read long, listed long, written long").filter(
        "listed = written"
    ).drop("written")


@query(over_captures("SELECT count(*) AS read, count(url) AS listed FROM caps"))
def list_warc_totals(spark, d):
    return search.list_warc_totals(capture_index(spark, d))


@query(over_captures(f"""SELECT CASE record_type WHEN 'response' THEN 'responses' ELSE 'requests' END AS archive, count(*) AS captures,
  count(DISTINCT url_key) AS urls, {STAMP_SQL.format('min(capture_ts)')} AS first_ts, {STAMP_SQL.format('max(capture_ts)')} AS last_ts
  FROM caps GROUP BY 1"""))
def archive_catalog(spark, d):
    """Two archives registered as views, and summed up with whatever else holds captures left out."""
    rows = capture_index(spark, d)
    names = {"responses": rows.filter("record_type = 'response'"), "requests": rows.filter("record_type <> 'response'")}
    for name, part in names.items():
        part.createOrReplaceTempView(name)
    catalogued = search.archive_catalog(spark).filter(F.col("archive").isin(*names))
    return catalogued.select("archive", "captures", "urls", stamp("first_ts").alias("first_ts"), stamp("last_ts").alias("last_ts"))


def _placed(rows: DataFrame) -> DataFrame:
    """Sorted rows with their place in the order, so that a comparison of rows sees the order."""
    ordered = cut_lineage(rows.withColumns({"_key": F.monotonically_increasing_id(), "_one": F.lit(1).cast("long")}))
    return running_totals(ordered, "_key", "_one").select(*rows.columns, (F.col("before") + 1).alias("place"))


@query(over_captures("""SELECT domain, n, row_number() OVER (ORDER BY n DESC, domain) AS place FROM
  (SELECT split_part(url_key, '/', 1) AS domain, count(DISTINCT url_key) AS n FROM caps GROUP BY 1)"""))
def domains_in_order(spark, d):
    return _placed(counts.count_domains(capture_index(spark, d)))


@query(over_captures(f"""SELECT url_key, {STAMP_SQL.format('capture_ts')} AS seen, row_number() OVER (ORDER BY url_key, capture_ts) AS place
  FROM (SELECT DISTINCT url_key, capture_ts FROM caps)"""))
def history_in_order(spark, d):
    return _placed(versions.capture_history(capture_index(spark, d)).select("url_key", stamp("capture_ts").alias("seen")))


@query(over_captures(f"""SELECT source_offset, row_number() OVER (ORDER BY url_key, capture_ts, source_offset) AS place FROM caps"""))
def captures_in_key_order(spark, d):
    """Captures of equal key and time are told apart by their offset here, in either engine."""
    index = capture_index(spark, d)
    ordered = cut_lineage(ingest.sorted_by_key(index).withColumn("_key", F.monotonically_increasing_id()).select("url_key", "capture_ts", "source_offset", "_key"))
    first = ordered.groupBy("url_key", "capture_ts").agg(F.min("_key").alias("_key"), F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list("source_offset")).alias("_offsets"))
    placed = running_totals(first, "_key", "_n")
    return placed.select(F.posexplode("_offsets").alias("_at", "source_offset"), "before").select("source_offset", (F.col("before") + F.col("_at") + 1).alias("place"))


# Versions of a URL


@query(over_captures(f"""SELECT url_key, {STAMP_SQL.format('capture_ts')} AS seen FROM caps
  WHERE url_key = (SELECT {key_sql('min(url)')} FROM pages) GROUP BY ALL"""))
def capture_history(spark, d):
    url = table(spark, d, "pages").agg(F.min("url")).first()[0]
    return versions.capture_history(capture_index(spark, d), url).select("url_key", stamp("capture_ts").alias("seen"))


@query(over_captures(f"""SELECT url_key, {STAMP_SQL.format('capture_ts')} AS seen,
  {STAMP_SQL.format('coalesce(lag(capture_ts) OVER w, capture_ts)')} AS previous,
  {STAMP_SQL.format('coalesce(lead(capture_ts) OVER w, capture_ts)')} AS following
FROM (SELECT DISTINCT url_key, capture_ts FROM caps) WINDOW w AS (PARTITION BY url_key ORDER BY capture_ts)"""))
def capture_nav(spark, d):
    return versions.capture_nav(capture_index(spark, d)).select(
        "url_key", stamp("capture_ts").alias("seen"), stamp("prev_ts").alias("previous"), stamp("next_ts").alias("following")
    )


@query(over_captures(f"""SELECT url_key, count(*) AS captures, {STAMP_SQL.format('min(capture_ts)')} AS first_ts,
  {STAMP_SQL.format('max(capture_ts)')} AS last_ts FROM caps GROUP BY url_key"""))
def capture_span(spark, d):
    return versions.capture_span(capture_index(spark, d)).select(
        "url_key", "captures", stamp("first_ts").alias("first_ts"), stamp("last_ts").alias("last_ts")
    )


@query(over_captures("""SELECT source_file, source_offset, url_key, content_type, strftime(date_trunc('day', capture_ts), '%Y%m%d%H%M%S') AS capture_date
  FROM caps QUALIFY row_number() OVER (PARTITION BY url_key, content_type, date_trunc('day', capture_ts)
  ORDER BY source_file DESC, source_offset DESC) = 1"""))
def latest_write(spark, d):
    return versions.latest_write(_daily(capture_index(spark, d))).select(
        "source_file", "source_offset", "url_key", "content_type", stamp("capture_ts").alias("capture_date")
    )


@query(over_captures("""SELECT source_file, source_offset, url_key, content_type, capture_date FROM caps
  QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY capture_ts DESC, source_file DESC, source_offset DESC) = 1"""))
def latest_capture(spark, d):
    return versions.latest_capture(capture_index(spark, d)).select(
        "source_file", "source_offset", "url_key", "content_type", "capture_date"
    )


REQUESTS_SQL = """requests AS (SELECT source_offset AS request, url_key,
  CASE WHEN content_type IS NULL THEN capture_ts ELSE capture_ts + to_days(CAST(source_offset % 9 - 4 AS INTEGER)) + to_seconds(source_offset % 5) END AS request_ts
  FROM caps)"""


@query(over_captures(f"""SELECT r.request, r.url_key, {STAMP_SQL.format('r.request_ts')} AS asked,
  {STAMP_SQL.format('coalesce(min(c.capture_ts) FILTER (c.capture_ts >= r.request_ts), max(c.capture_ts))')} AS served
  FROM requests r JOIN caps c USING (url_key) GROUP BY ALL""", REQUESTS_SQL))
def as_of_lookup(spark, d):
    index = capture_index(spark, d)
    days = (F.col("source_offset") % 9 - 4).cast("int")
    moved = F.col("capture_ts") + F.make_dt_interval(days=days, secs=F.col("source_offset") % 5)
    requests = index.select(
        F.col("source_offset").alias("request"),
        "url_key",
        F.when(F.col("content_type").isNull(), F.col("capture_ts")).otherwise(moved).alias("request_ts"),
    )
    return versions.as_of(requests, index).select(
        "request", "url_key", stamp("request_ts").alias("asked"), stamp("served_ts").alias("served")
    )


# Link graph

LINKS_SQL = """links AS (SELECT page_id, url, regexp_extract(url, '^https?://[^/?#]*') || l.href AS target, l.anchor FROM
  (SELECT page_id, url, unnest(list_zip(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1),
     regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2))) AS pair FROM pages) p,
  LATERAL (SELECT replace(p.pair[1], '&amp;', '&') AS href, trim(replace(p.pair[2], '&amp;', '&')) AS anchor) l)"""
URLS_SQL = "urls AS (SELECT url FROM pages UNION ALL SELECT target FROM links)"
IDS_SQL = "ids AS (SELECT DISTINCT url, rank() OVER (ORDER BY url) AS id FROM urls)"
GRAPH_SQL = f"{LINKS_SQL}, {URLS_SQL}, {IDS_SQL}"


def _links(spark, d, parser="html") -> DataFrame:
    return graph.extract_links(page_captures(spark, d), "UTF-8", parser)


def _urls(spark, d) -> DataFrame:
    """Every page URL and every link target, once per mention."""
    return table(spark, d, "pages").select("url").unionByName(_links(spark, d).select(F.col("target").alias("url")))


def _url_ids(spark, d) -> DataFrame:
    """The numbered URLs, written once: most jobs look ids up more than once."""
    return cut_lineage(urlids.build_url_ids(_urls(spark, d)))


@query(f"WITH {LINKS_SQL} SELECT page_id, url, target, anchor FROM links")
def extract_links(spark, d):
    return _links(spark, d).select(F.col("source_offset").alias("page_id"), "url", "target", "anchor")


@query(f"WITH {LINKS_SQL} SELECT page_id, url, target FROM links")
def extract_links_plain(spark, d):
    return _links(spark, d, "plain").select(F.col("source_offset").alias("page_id"), "url", "target")


@query(f"WITH {GRAPH_SQL} SELECT url, id FROM ids")
def build_url_ids(spark, d):
    return urlids.build_url_ids(_urls(spark, d))


@query("SELECT url, row_number() OVER (ORDER BY url) AS id FROM (SELECT DISTINCT url FROM pages)")
def build_url_ids_dense(spark, d):
    return urlids.build_url_ids(table(spark, d, "pages").select("url"), dense=True)


@query("""WITH ids AS (SELECT url, rank() OVER (ORDER BY url) AS id FROM pages)
SELECT e.event_id, coalesce(ids.id, -1) AS id FROM events e LEFT JOIN pages p ON p.page_id = e.event_id LEFT JOIN ids ON ids.url = coalesce(p.url, e.event_type)""")
def lookup_ids(spark, d):
    pages = table(spark, d, "pages")
    asked = table(spark, d, "events").join(pages, F.col("event_id") == F.col("page_id"), "left")
    urls = asked.select("event_id", F.coalesce("url", "event_type").alias("url"))
    return urlids.lookup_ids(urls, urlids.build_url_ids(pages.select("url"))).select("event_id", "id")


@query("""WITH ids AS (SELECT url, rank() OVER (ORDER BY url) AS id FROM pages)
SELECT e.event_id, ids.url FROM events e JOIN ids ON ids.id = e.user_id""")
def lookup_urls(spark, d):
    ids = table(spark, d, "events").select("event_id", F.col("user_id").alias("id"))
    return urlids.lookup_urls(ids, urlids.build_url_ids(table(spark, d, "pages").select("url"))).select("event_id", "url")


@query(f"WITH {GRAPH_SQL} SELECT url FROM ids WHERE starts_with(url, 'https://blog.t')")
def prefix_search(spark, d):
    return urlids.prefix_search(_url_ids(spark, d), "https://blog.t").select("url")


PREFIXES_SQL = """prefixes AS (SELECT row_number() OVER (ORDER BY prefix) AS id, prefix FROM (
  SELECT regexp_extract(url, '^https?://[^/?#]*') || '/' AS prefix FROM pages UNION
  SELECT regexp_extract(url, '^https?://[^/?#]*/[a-z]+') AS prefix FROM pages UNION
  SELECT 'none:' || lang FROM documents))"""
RANGES_SQL = f"""{PREFIXES_SQL}, ranges AS (SELECT p.id, p.prefix, min(i.id) AS start_id, max(i.id) AS end_id
  FROM prefixes p LEFT JOIN ids i ON starts_with(i.url, p.prefix) GROUP BY p.id, p.prefix)"""


def _prefixes(spark, d) -> DataFrame:
    """Each site, each language folder inside it, and a few prefixes that no URL has."""
    pages = table(spark, d, "pages")
    site = F.concat(F.regexp_extract("url", "^https?://[^/?#]*", 0), F.lit("/"))
    folder = F.regexp_extract("url", "^https?://[^/?#]*/[a-z]+", 0)
    absent = table(spark, d, "documents").select(F.concat(F.lit("none:"), "lang").alias("url"))
    every = pages.select(site.alias("url")).union(pages.select(folder.alias("url"))).union(absent)
    return urlids.build_url_ids(every, dense=True).select("id", F.col("url").alias("prefix"))


@query(f"WITH {GRAPH_SQL}, {RANGES_SQL} SELECT id, prefix, start_id, end_id FROM ranges")
def prefix_id_ranges(spark, d):
    return urlids.prefix_id_ranges(_prefixes(spark, d), _url_ids(spark, d))


def _page_graph(spark, d) -> DataFrame:
    pages = graph.page_links(captures(spark, d), "UTF-8")
    return graph.page_graph(pages, _url_ids(spark, d))


PAGE_GRAPH_SQL = f"""{CAPTURES_SQL}, {GRAPH_SQL}, linked AS (SELECT DISTINCT l.page_id, i.id AS dst FROM links l JOIN ids i ON i.url = l.target),
page_dst AS (SELECT page_id, list(dst ORDER BY dst) AS dst FROM linked GROUP BY page_id),
graph AS (SELECT c.source_offset, i.id AS src, coalesce(t.dst, []) AS dst FROM caps c JOIN ids i ON i.url = c.url
  LEFT JOIN page_dst t ON t.page_id = c.page_id WHERE c.content_type = 'text/html')"""


@query(f"WITH {PAGE_GRAPH_SQL} SELECT source_offset, src, array_to_string(dst, ',') AS dst FROM graph")
def page_graph(spark, d):
    return _page_graph(spark, d).select("source_offset", "src", F.array_join("dst", ",").alias("dst"))


@query(f"WITH {PAGE_GRAPH_SQL} SELECT source_offset, src, array_to_string(dst, ',') AS dst FROM graph")
def page_graph_of_saved_ids(spark, d):
    """The page graph over ids kept in a bucketed table, of which only the ids in use are moved."""
    folder = scratch(spark, "url_ids")
    saved = urlids.save_url_ids(urlids.build_url_ids(_urls(spark, d)), folder.rsplit("/", 1)[1].replace("-", "_"), 8, path=folder)
    pages = cut_lineage(graph.page_links(captures(spark, d), "UTF-8"))
    used = cut_lineage(urlids.ids_in_use(graph.linked_urls(pages), saved, 8))
    return graph.page_graph(pages, used).select("source_offset", "src", F.array_join("dst", ",").alias("dst"))


@query(f"""WITH {PAGE_GRAPH_SQL} SELECT (SELECT count(*) FROM caps) AS records,
  (SELECT CAST(sum(greatest(len(dst), 1)) AS BIGINT) FROM graph) AS links""")
def link_stats(spark, d):
    return graph.link_stats(capture_index(spark, d), _page_graph(spark, d))


@query(f"""WITH {LINKS_SQL} SELECT page_id, count(DISTINCT target) AS targets FROM links GROUP BY page_id""")
def distinct_targets(spark, d):
    pages = graph.page_links(page_captures(spark, d), "UTF-8")
    targets = F.size(graph.page_targets(F.col("links"))).cast("long")
    return pages.select(F.col("source_offset").alias("page_id"), targets.alias("targets")).filter("targets > 0")


@query(f"WITH {GRAPH_SQL}, {CAPTURES_SQL} SELECT c.source_offset, i.id AS src FROM caps c JOIN ids i ON i.url = c.url")
def page_ids(spark, d):
    urls = capture_index(spark, d).select("source_offset", "url")
    return graph.with_page_ids(urls, _url_ids(spark, d)).select("source_offset", "src")


@query(f"WITH {GRAPH_SQL} SELECT l.page_id, l.target, i.id AS dst FROM links l JOIN ids i ON i.url = l.target")
def target_ids(spark, d):
    targets = _links(spark, d).select(F.col("source_offset").alias("page_id"), "target")
    return graph.target_ids(targets, _url_ids(spark, d)).select("page_id", "target", "dst")


@query(f"WITH {GRAPH_SQL}, {RANGES_SQL} SELECT i.id AS page, r.id AS site FROM ids i JOIN ranges r ON i.id BETWEEN r.start_id AND r.end_id")
def ids_in_ranges(spark, d):
    ids = _url_ids(spark, d)
    ranges = urlids.prefix_id_ranges(_prefixes(spark, d), ids)
    return graph.sites_of_ids(ids.select(F.col("id").alias("page")), "page", ranges, "site").select("page", "site")


WALKS_SQL = """walks AS (SELECT p.url AS src_url, q.url AS dst_url FROM events e
  JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
  JOIN pages q ON q.page_id = (e.event_id * 7 + e.user_id) % (SELECT count(*) FROM pages)),
edges AS (SELECT DISTINCT s.id AS src, t.id AS dst FROM walks w JOIN ids s ON s.url = w.src_url JOIN ids t ON t.url = w.dst_url)"""


def _walks(spark, d, ids) -> DataFrame:
    """An adjacency between pages of different sites: each event leads from its page to another."""
    pages = table(spark, d, "pages")
    total = pages.agg(F.count(F.lit(1))).scalar()
    steps = table(spark, d, "events").select(
        (F.col("event_id") % total).alias("a"), ((F.col("event_id") * 7 + F.col("user_id")) % total).alias("b")
    )
    numbered = pages.join(ids, "url").select("page_id", "id")
    source = numbered.select(F.col("page_id").alias("a"), F.col("id").alias("src"))
    target = numbered.select(F.col("page_id").alias("b"), F.col("id").alias("dst"))
    edges = steps.join(source, "a").join(target, "b").select("src", "dst").distinct()
    return edges.select("src", F.array("dst").alias("dst"))


@query(f"""WITH {GRAPH_SQL}, {RANGES_SQL}, {WALKS_SQL},
nearest AS (SELECT e.src, e.dst, arg_max(r.id, length(r.prefix) * 1000000 - r.id) AS target FROM edges e
  JOIN ranges r ON e.dst BETWEEN r.start_id AND r.end_id GROUP BY e.src, e.dst)
SELECT s.id AS source, n.target, count(*) AS weight FROM nearest n JOIN ranges s ON n.src BETWEEN s.start_id AND s.end_id GROUP BY ALL""")
def site_graph(spark, d):
    ids = _url_ids(spark, d)
    ranges = urlids.prefix_id_ranges(_prefixes(spark, d), ids)
    return graph.site_graph(_walks(spark, d, ids), ranges)


# Seeds, sites and outlinks

HOSTS_SQL = f"hosts AS (SELECT DISTINCT regexp_replace({HOST_SQL.format('url')}, '^www[.]', '') AS host FROM pages)"
MATCH_SQL = "(h.host = {0} OR contains(h.host, '.' || {0}))"
SEEDED_SQL = f"""{HOSTS_SQL}, {SEEDS_SQL}, {META_SQL},
seeded AS (SELECT DISTINCT h.host FROM hosts h JOIN seeds s ON {MATCH_SQL.format('s.host')}),
codes AS (SELECT regexp_replace({HOST_SQL.format('url')}, '^www[.]', '') AS site, arg_max(code, line_no) AS code FROM meta GROUP BY 1),
host_codes AS (SELECT h.host, arg_max(c.code, lpad(length(c.site)::VARCHAR, 4, '0') || c.site) AS code FROM hosts h
  JOIN codes c ON {MATCH_SQL.format('c.site')} GROUP BY h.host)"""


def _hosts(spark, d) -> DataFrame:
    return table(spark, d, "pages").select(K.host_name("url").alias("host"))


@query(f"WITH {SEEDED_SQL} SELECT host FROM seeded")
def seed_membership(spark, d):
    return outlinks.seed_hosts(_hosts(spark, d), _seeds(spark, d))


@query(f"WITH {SEEDED_SQL} SELECT host, code FROM host_codes")
def site_code_by_host(spark, d):
    return outlinks.host_codes(_hosts(spark, d), _meta(spark, d))


@query(f"WITH {SITE_OF_KEY_SQL} SELECT url_key, site_id FROM sites")
def site_of_key(spark, d):
    return text.site_of_key(page_captures(spark, d), _site_ids(spark, d))


@query(f"""WITH {META_SQL}, {SITE_IDS_SQL}, codes AS (SELECT string_split(lower({HOST_SQL.format('url')}), '.')[-2] AS label,
  arg_max(code, line_no) AS code FROM meta GROUP BY 1), asked AS (SELECT site_id AS label FROM ids UNION ALL SELECT DISTINCT label FROM codes)
SELECT label, code FROM asked LEFT JOIN codes USING (label)""")
def code_by_label(spark, d):
    known = table(spark, d, "pages").select(K.site_label("url").alias("label")).distinct()
    labels = _site_ids(spark, d).select(F.col("site_id").alias("label")).unionByName(known)
    return outlinks.code_by_label(labels, _meta(spark, d))


@query(f"""WITH {META_SQL}, codes AS (SELECT string_split(lower({HOST_SQL.format('url')}), '.')[-2] AS label, arg_max(code, line_no) AS code FROM meta GROUP BY 1)
SELECT page_id, code FROM pages LEFT JOIN codes ON label = string_split(lower({HOST_SQL.format('pages.url')}), '.')[-2]""")
def site_code_in_sql(spark, d):
    """The code of each page's site by its label, looked up by a function inside a SQL text."""
    register_site_codes(spark, _meta(spark, d))
    labelled = table(spark, d, "pages").select("page_id", K.site_label("url").alias("label"))
    return spark.sql("SELECT page_id, site_code(label) AS code FROM {labelled}", labelled=labelled)


def _outlink_captures(spark, d) -> DataFrame:
    named = F.create_map(F.lit("content-type"), F.lit("text/html; charset=utf-8"))
    return captures(spark, d).withColumn("http_headers", named)


OUT_SQL = f"""{CAPTURES_SQL}, {LINKS_SQL}, {SEEDED_SQL},
page_days AS (SELECT url_key || '|' || substr(capture_date, 1, 8) AS row_key, url_key, substr(capture_date, 1, 8) AS day, page_id, url,
  source_file, source_offset, content FROM caps WHERE content_type LIKE '%html%'),
marks AS (SELECT host, code, true AS in_seeds FROM seeded LEFT JOIN host_codes USING (host))"""


@query(f"""WITH {OUT_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY page_id) AS pos FROM links),
last AS (SELECT d.row_key, d.url_key, d.day, l.target AS href, arg_max(l.anchor, d.source_file || lpad(d.source_offset::VARCHAR, 12, '0') || lpad(l.pos::VARCHAR, 6, '0')) AS anchor
  FROM page_days d JOIN numbered l USING (page_id) WHERE l.anchor <> '' GROUP BY ALL)
SELECT row_key, url_key, day, href, regexp_replace(anchor, '[^ A-Za-z,'']+', '', 'g') AS anchor, code, coalesce(in_seeds, false) AS in_seeds
FROM last LEFT JOIN marks ON marks.host = regexp_replace({HOST_SQL.format('last.href')}, '^www[.]', '')""")
def extract_outlinks(spark, d):
    return outlinks.extract_outlinks(_outlink_captures(spark, d), _seeds(spark, d), _meta(spark, d), absolute_only=False)


@query(f"""WITH {OUT_SQL}, whole AS (SELECT page_id, row_number() OVER (PARTITION BY page_id) AS pos, replace(pair[1], '&amp;', '&') AS target,
  trim(replace(pair[2], '&amp;', '&')) AS anchor FROM (SELECT page_id, unnest(list_zip(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1),
  regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2))) AS pair FROM (SELECT page_id, replace(html, '<a href="/', '<a href="http://www.far.example.org/') AS html FROM pages WHERE page_id % 2 = 0
  UNION ALL SELECT page_id, html FROM pages WHERE page_id % 2 = 1))),
last AS (SELECT d.row_key, d.url_key, d.day, l.target AS href, arg_max(l.anchor, d.source_file || lpad(d.source_offset::VARCHAR, 12, '0') || lpad(l.pos::VARCHAR, 6, '0')) AS anchor
  FROM page_days d JOIN whole l USING (page_id) WHERE l.anchor <> '' AND l.target LIKE 'http%' GROUP BY ALL)
SELECT row_key, url_key, day, href, regexp_replace(anchor, '[^ A-Za-z,'']+', '', 'g') AS anchor, code, coalesce(in_seeds, false) AS in_seeds
FROM last LEFT JOIN marks ON marks.host = regexp_replace({HOST_SQL.format('last.href')}, '^www[.]', '')""")
def extract_outlinks_absolute(spark, d):
    """Only links absolute as written: those of every second page are made so, the others have none."""
    pages = _outlink_captures(spark, d)
    even = table(spark, d, "pages").filter("page_id % 2 = 0").select("url")
    made = F.replace(F.col("content").cast("string"), F.lit('<a href="/'), F.lit('<a href="http://www.far.example.org/')).cast("binary")
    is_even = F.col("_even").isNotNull()
    marked = pages.join(even.distinct().select(F.col("url").alias("_even")), F.col("url") == F.col("_even"), "left")
    return outlinks.extract_outlinks(
        marked.withColumn("content", F.when(is_even, made).otherwise(F.col("content"))).drop("_even"), _seeds(spark, d), _meta(spark, d)
    )


@query(f"""WITH {OUT_SQL}, last AS (SELECT * FROM page_days QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY source_file DESC, source_offset DESC) = 1)
SELECT row_key, url_key, day, code, coalesce(in_seeds, false) AS in_seeds, md5(content) AS hash
FROM last LEFT JOIN marks ON marks.host = regexp_replace({HOST_SQL.format('last.url')}, '^www[.]', '')""")
def outlink_pages(spark, d):
    return outlinks.outlink_pages(_outlink_captures(spark, d), _seeds(spark, d), _meta(spark, d))


# Text and replay

TEXT_SQL = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->|<!DOCTYPE[^>]*>|(?s:<script>.*?</script>)|(?s:<style>.*?</style>)', '', 'g'),
    '</?(html|head|body|meta|title|nav|ul|li|div|article|h[1-6]|p|br|footer)(\s[^>]*)?>', ' ', 'g'), '<[^>]*>', '', 'g'),
  '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '[ \t\n\r\f\v]+', ' ', 'g'))"""


@query(f"""WITH {SITE_OF_KEY_SQL}, {CAPTURES_SQL} SELECT s.site_id, c.url_key, c.capture_date,
  c.capture_date || sha1(c.url_key) || '.txt' AS file_name, {TEXT_SQL.replace('html, ', 'content, ', 1)} AS text
FROM caps c JOIN sites s USING (url_key) WHERE c.content_type LIKE '%html%'""")
def extract_text(spark, d):
    return text.extract_text(captures(spark, d), _site_ids(spark, d))


@query("SELECT page_id, regexp_replace(html, '<.*?>', '', 'g') AS text FROM pages")
def strip_tags(spark, d):
    return text.strip_tags(page_captures(spark, d)).select(F.col("source_offset").alias("page_id"), "text")


@query(over_captures(r"""SELECT url_key, url, strftime(capture_ts, '%Y%m%d%H%M%S') AS seen,
  md5(regexp_replace(content, '<a href="(/[^"]*)"', '<a href="http://replay.example/crawl/' || epoch_ms(capture_ts) || '/' ||
    regexp_extract(url, '^https?://[^/?#]*') || '\1"', 'g')) AS hash FROM caps WHERE content_type = 'text/html'"""))
def rewrite_links(spark, d):
    copies = text.rewrite_links(captures(spark, d), "http://replay.example/", "crawl")
    return copies.select("url_key", "url", stamp("capture_ts").alias("seen"), F.md5(F.col("html").cast("binary")).alias("hash"))
