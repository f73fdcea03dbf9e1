"""Counting and duplicate reports over captures.

None of these reads `content` but `detect_duplicates`, and that only where no digest is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.functions.dates import capture_day
from crawlstrata.functions.keys import file_type, key_domain, key_to_host
from crawlstrata.operators.search import distinct_urls

# The name given to keys without a file type.
NO_FILE_TYPE = "unknown"


def count_by(captures: DataFrame, key: Column, name: str = "key") -> DataFrame:
    """Captures per value of `key`, in key order; null is a group of its own."""
    return captures.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n")).orderBy(name)


def count_content_types(captures: DataFrame) -> DataFrame:
    return count_by(captures, F.col("content_type"), "content_type")


def count_crawl_dates(captures: DataFrame) -> DataFrame:
    """Captures per day; dates shorter than a day are left to `crawl_date_totals`."""
    return count_by(captures.filter(capture_day("capture_date").isNotNull()), capture_day("capture_date"), "day")


def crawl_date_totals(captures: DataFrame) -> DataFrame:
    """One row: captures read, and those whose date is too short or missing."""
    return captures.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(capture_day("capture_date").isNull()).alias("errors")
    )


def count_urls(captures: DataFrame) -> DataFrame:
    return count_by(captures, F.col("url"), "url")


def _by_frequency(rows: DataFrame, key: Column, name: str) -> DataFrame:
    counted = rows.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), name)


def count_file_types(captures: DataFrame) -> DataFrame:
    """Distinct keys per file type, most frequent first."""
    kind = file_type("url_key")
    return _by_frequency(distinct_urls(captures), F.when(kind == "", NO_FILE_TYPE).otherwise(kind), "file_type")


def count_domains(captures: DataFrame) -> DataFrame:
    """Distinct keys per domain, most frequent first."""
    return _by_frequency(distinct_urls(captures), key_domain("url_key"), "domain")


def count_rows(captures: DataFrame) -> DataFrame:
    """One row: the number of distinct keys."""
    return distinct_urls(captures).agg(F.count(F.lit(1)).alias("n"))


def host_directory(captures: DataFrame, server: str, name: str) -> DataFrame:
    """Hosts by number of distinct keys, each with a link that searches the archive for it."""
    hosts = _by_frequency(distinct_urls(captures), key_to_host("url_key"), "host")
    return hosts.withColumn("link", F.concat(F.lit(f"{server}{name}?query="), "host", F.lit("/")))


def duplicate_groups(captures: DataFrame, scope: str = "all_captures") -> DataFrame:
    """Per URL and content held more than once: copies, unordered pairs, bytes summed once per pair.

    `all_captures` compares every capture of a URL; `latest_per_type` only the newest of each type.
    Stored digests and lengths are used where there are any, so content need not be read. Pair
    counts are decimals, as a third of an archive in one group overflows 64 bits.
    """
    if scope == "latest_per_type":
        newest = F.max_by("_cell", F.struct("capture_ts", "source_file", "source_offset"))
    elif scope != "all_captures":
        raise ValueError(scope)
    stored = {"content_sha", "content_length"} <= set(captures.columns)
    digest = F.col("content_sha") if stored else F.sha2("content", 256)
    size = F.col("content_length") if stored else F.octet_length("content")
    cells = captures.filter(F.col("url_key").isNotNull())
    cell = F.struct(digest.alias("digest"), size.cast("long").alias("length")).alias("_cell")
    if scope == "latest_per_type":
        kept = cells.select("url_key", "content_type", "capture_ts", "source_file", "source_offset", cell)
        cells = kept.groupBy("url_key", "content_type").agg(newest.alias("_cell"))
    else:
        cells = cells.select("url_key", cell)
    known = cells.filter(F.col("_cell.digest").isNotNull())
    copies = F.col("copies").cast("decimal(19,0)")
    pairs = (copies * (copies - 1) / 2).cast("decimal(38,0)")
    return (
        known.groupBy("url_key", F.col("_cell.digest").alias("digest"), F.col("_cell.length").alias("length"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .withColumn("pairs", pairs)
        .withColumn("pair_bytes", (F.col("pairs") * F.col("length")).cast("decimal(38,0)"))
    )


def detect_duplicates(captures: DataFrame, scope: str = "all_captures") -> DataFrame:
    """One row: pairs of equal content within a URL, and their bytes."""
    total = duplicate_groups(captures, scope).agg(F.sum("pairs").alias("p"), F.sum("pair_bytes").alias("b"))
    zero = F.lit(0).cast("decimal(38,0)")
    return total.select(
        F.coalesce("p", zero).cast("decimal(38,0)").alias("duplicates"),
        F.coalesce("b", zero).cast("decimal(38,0)").alias("duplicate_bytes"),
    )
