"""Archive views of the given tables, and their DuckDB text.

Every event is one capture of a page: the page and the document are picked by the event's number,
so each view grows with the tables. No view keeps only a part of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstrata.functions.keys import url_key
from crawlstrata.session import prepare


# Captures that a part of the HTML captures has, about: so much parsing that a task is neither short nor the last for long.
PART_CAPTURES = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(ts) -> Column:
    """A time as its 14-digit string, so that both engines print it alike."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def _placed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events as captures that still lack their page, and the pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", url_key("url").alias("url_key"), "html")
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").select(
        F.concat(F.lit("crawl-"), F.date_format("ts", "yyyyMMdd"), F.lit(".warc.gz")).alias("source_file"),
        F.col("event_id").alias("source_offset"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("capture_ts"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("capture_date"),
        F.when(kind == "purchase", "text/plain").when(kind != "error", "text/html").alias("content_type"),
        F.when(kind == "signup", "request").otherwise("response").alias("record_type"),
        kind.isin("purchase", "error").alias("is_document"),
        (F.col("event_id") % pages.agg(F.count(F.lit(1))).scalar()).alias("page_id"),
    )
    return events, pages


def capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures without their content: all that counting, listing and version jobs read."""
    events, pages = _placed(spark, sf_dir)
    return events.join(pages.drop("html"), "page_id").drop("is_document", "page_id")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures with content: page HTML, or document text for plain and untyped captures.

    Only HTML captures meet the pages' HTML and only the others the documents' text. Lengths are taken
    before the joins, so a job that reads no content moves none.
    """
    events, pages = _placed(spark, sf_dir)
    texts = table(spark, sf_dir, "documents")
    texts = texts.select("doc_id", *_content("text"))
    # A page is captured many times: parts are counted by captures, not by the few bytes that both sides have before
    # they meet. Merged, as sending the events to the pages would leave all captures in the tasks that read pages.
    parts = -(-events.count() // PART_CAPTURES) or 1
    of_pages = (
        events.filter(~F.col("is_document"))
        .repartition(parts, "page_id")
        .join(pages.select("page_id", "url", "url_key", *_content("html")).repartition(parts, "page_id").hint("merge"), "page_id")
    )
    of_documents = (
        events.filter("is_document")
        .withColumn("doc_id", F.col("source_offset") % texts.agg(F.count(F.lit(1))).scalar())
        .join(pages.drop("html"), "page_id")
        .join(texts, "doc_id")
        .drop("doc_id")
    )
    return of_pages.unionByName(of_documents).drop("is_document", "page_id")


def _content(column: str) -> list[Column]:
    return [F.col(column).cast("binary").alias("content"), F.octet_length(column).cast("long").alias("content_length")]


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page captured once, as HTML."""
    return table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source_file"),
        F.col("page_id").alias("source_offset"),
        "url",
        url_key("url").alias("url_key"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("page_id")).alias("capture_ts"),
        F.lit("text/html").alias("content_type"),
        F.lit("response").alias("record_type"),
        F.col("html").cast("binary").alias("content"),
        F.octet_length("html").cast("long").alias("content_length"),
    ).withColumn("capture_date", stamp("capture_ts"))


HOST_SQL = "regexp_extract({0}, '^https?://([^/?#]*)', 1)"
REST_SQL = "regexp_extract({0}, '^https?://[^/?#]*([^#]*)', 1)"


def key_sql(url: str) -> str:
    """DuckDB text of the reversed key of a plain http(s) URL."""
    host, rest = HOST_SQL.format(url), REST_SQL.format(url)
    return f"array_to_string(list_reverse(string_split({host}, '.')), '.') || {rest}"


STAMP_SQL = "strftime({0}, '%Y%m%d%H%M%S')"

CAPTURES_SQL = f"""caps AS (
  SELECT 'crawl-' || strftime(e.ts, '%Y%m%d') || '.warc.gz' AS source_file, e.event_id AS source_offset,
         p.page_id, p.url, {key_sql('p.url')} AS url_key, date_trunc('second', e.ts) AS capture_ts,
         strftime(e.ts, '%Y%m%d%H%M%S') AS capture_date,
         CASE e.event_type WHEN 'purchase' THEN 'text/plain' WHEN 'error' THEN NULL ELSE 'text/html' END AS content_type,
         CASE e.event_type WHEN 'signup' THEN 'request' ELSE 'response' END AS record_type,
         CASE WHEN e.event_type IN ('purchase', 'error') THEN d.text ELSE p.html END AS content,
         CAST(strlen(CASE WHEN e.event_type IN ('purchase', 'error') THEN d.text ELSE p.html END) AS BIGINT) AS content_length
  FROM events e
  JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
  JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents))"""
