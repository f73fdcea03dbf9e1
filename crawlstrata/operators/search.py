"""Listings, filters and search over captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The exact type of the graph's pages, the text that marks HTML for the other jobs.
HTML_TYPE = "text/html"
HTML_MARK = "html"


def list_arc(captures: DataFrame) -> DataFrame:
    """(`url type`, date) of every capture."""
    return captures.select(F.concat_ws(" ", "url", "content_type").alias("url_type"), "capture_date")


def list_warc(captures: DataFrame, totals: Observation | None = None) -> DataFrame:
    """(url, date) of every record that has a URL, whatever its type.

    `totals` then has the records `read` and `listed` once the listing has been written: one pass gives both.
    """
    if totals is not None:
        captures = captures.observe(totals, F.count(F.lit(1)).alias("read"), F.count("url").alias("listed"))
    return captures.filter(F.col("url").isNotNull()).select("url", "capture_date")


def list_warc_totals(captures: DataFrame) -> DataFrame:
    """One row: records read, and those that `list_warc` lists."""
    return captures.agg(F.count(F.lit(1)).alias("read"), F.count("url").alias("listed"))


def find_url(captures: DataFrame, url: str | Column) -> DataFrame:
    """Where a URL, exactly as written, was captured."""
    return captures.filter(F.col("url") == F.lit(url)).select(
        "source_file", "capture_date", "content_type", "content_length", "url_key"
    )


def is_html(mode: str = "exact", content_type: str = "content_type") -> Column:
    """Whether a type is `text/html` itself (`exact`) or names html anywhere (`contains`); null is not."""
    kind = F.coalesce(content_type, F.lit(""))
    return {"exact": kind == HTML_TYPE, "contains": kind.contains(HTML_MARK)}[mode]


def html_only(captures: DataFrame, mode: str = "exact") -> DataFrame:
    return captures.filter(is_html(mode))


def distinct_urls(captures: DataFrame) -> DataFrame:
    """One row per key, whatever its versions."""
    return captures.filter(F.col("url_key").isNotNull()).select("url_key").distinct()


def archive_summary(captures: DataFrame, archive: str) -> DataFrame:
    """Per archive: captures, distinct keys, first and last capture.

    Captures are first counted per (archive, key), so a large archive is added up in parallel.
    """
    per_key = captures.groupBy(archive, "url_key").agg(
        F.count(F.lit(1)).alias("c"), F.min("capture_ts").alias("f"), F.max("capture_ts").alias("l")
    )
    return per_key.groupBy(archive).agg(
        F.sum("c").alias("captures"),
        F.count("url_key").alias("urls"),
        F.min("f").alias("first_ts"),
        F.max("l").alias("last_ts"),
    )


def archive_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Summary of every table that holds captures, by table name."""
    summaries = None
    for table in spark.catalog.listTables(database) if database else spark.catalog.listTables():
        name = table.name if table.isTemporary or not table.namespace else ".".join([*table.namespace, table.name])
        captures = spark.table(name)
        if {"url_key", "capture_ts"} <= set(captures.columns):
            one = archive_summary(captures.withColumn("archive", F.lit(table.name)), "archive")
            summaries = one if summaries is None else summaries.unionByName(one)
    if summaries is None:
        return spark.createDataFrame(
            [], "archive string, captures bigint, urls bigint, first_ts timestamp, last_ts timestamp"
        )
    return summaries.orderBy("archive")
