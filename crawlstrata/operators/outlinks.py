"""Outlinks of pages with what is known of the sites on both ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.functions.content import clean_anchor, content_hash, html_text_decode
from crawlstrata.functions.dates import capture_day
from crawlstrata.functions.keys import host_name, site_label
from crawlstrata.operators.graph import parsed_links
from crawlstrata.operators.search import html_only
from crawlstrata.operators.urlids import lengths_of
from crawlstrata.session import cut_lineage

# Links that are no pages.
MAIL = "mailto"


def _spans(host: Column, lengths: Column) -> Column:
    """The host, and each part of it that begins after a dot and has one of `lengths`."""
    starts = F.filter(F.sequence(F.lit(1), F.length(host)), lambda i: (i > 1) & (F.substring(host, i - 1, 1) == "."))
    parts = F.flatten(
        F.transform(
            starts,
            lambda i: F.transform(
                F.filter(lengths, lambda n: n <= F.length(host) - i + 1), lambda n: F.substring(host, i, n)
            ),
        )
    )
    return F.array_distinct(F.concat(F.array(host), parts))


def hosts_matching(hosts: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """Distinct hosts with each row of `names` they match: equal to it, or holding `.` and it anywhere.

    Parts of the host are joined by equality, so neither side is compared row by row.
    """
    distinct = hosts.select("host").filter(F.length("host") > 0).distinct()
    sized = distinct.withColumn("_lengths", lengths_of(names, name))
    parts = sized.select("host", F.explode(_spans(F.col("host"), F.col("_lengths"))).alias(name))
    return parts.join(names, name)


def seed_hosts(hosts: DataFrame, seeds: DataFrame) -> DataFrame:
    """The distinct hosts that match a seed."""
    return hosts_matching(hosts, seeds.select(F.col("host").alias("seed")), "seed").select("host").distinct()


def host_codes(hosts: DataFrame, meta: DataFrame) -> DataFrame:
    """(host, code) of distinct hosts that match a site; the longest site wins, then its last line."""
    sites = meta.select(host_name("url").alias("site"), "code", "line_no").filter(F.col("site").isNotNull())
    matches = hosts_matching(hosts, sites, "site")
    return matches.groupBy("host").agg(F.max_by("code", F.struct(F.length("site"), "site", "line_no")).alias("code"))


def code_by_label(labels: DataFrame, meta: DataFrame) -> DataFrame:
    """Adds the code of the site whose URL has this label; of repeated labels the last line counts."""
    codes = (
        meta.select(site_label("url").alias("label"), "code", "line_no")
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.max_by("code", "line_no").alias("code"))
    )
    return labels.join(codes, "label", "left")


def _marks(hosts: DataFrame, seeds: DataFrame, meta: DataFrame) -> DataFrame:
    """(host, code) of the hosts in a seed; the code is null where no site matches.

    Written once: a join with an aggregate on its own key could not be split for a host that most
    links lead to.
    """
    seeded = cut_lineage(seed_hosts(hosts, seeds))
    return cut_lineage(seeded.join(host_codes(seeded, meta), "host", "left").withColumn("in_seeds", F.lit(True)))


def _page_days(captures: DataFrame) -> DataFrame:
    """HTML captures with key and day, decoded, with the key of their row in the outlink tables."""
    day = capture_day("capture_date")
    pages = html_only(captures, "contains").filter(F.col("url_key").isNotNull() & day.isNotNull())
    return html_text_decode(
        pages.select(
            "source_file", "source_offset", "url_key", "url", "content_type", "content", "http_headers", day.alias("day")
        )
    ).withColumn("row_key", F.concat("url_key", F.lit("|"), "day"))


def outlink_pages(captures: DataFrame, seeds: DataFrame, meta: DataFrame) -> DataFrame:
    """One row per page and day: its code and seed membership, and the MD5 of its last HTML."""
    pages = _page_days(captures).select(
        "row_key", "url_key", "day", host_name("url").alias("host"), content_hash("text").alias("hash"),
        F.struct("source_file", "source_offset").alias("_written"),
    )
    last = pages.groupBy("row_key", "url_key", "day").agg(
        F.max_by(F.struct("host", "hash"), "_written").alias("last")
    ).select("row_key", "url_key", "day", "last.host", "last.hash")
    last = cut_lineage(last)
    return last.join(_marks(last, seeds, meta), "host", "left").select(
        "row_key", "url_key", "day", "code", F.coalesce("in_seeds", F.lit(False)).alias("in_seeds"), "hash"
    )


def extract_outlinks(captures: DataFrame, seeds: DataFrame, meta: DataFrame, absolute_only: bool = True) -> DataFrame:
    """One row per page, day and address: cleaned anchor, code and seed membership of its target.

    `absolute_only` keeps links that are absolute as written (or by a base element); otherwise
    relative links are resolved against the page. Links without text and mail links are dropped. Of
    one address repeated on a page-day, the last counts.
    """
    pages = _page_days(captures)
    base = F.lit("") if absolute_only else F.col("url")
    links = pages.select(
        "row_key", "url_key", "day", "source_file", "source_offset", F.posexplode(parsed_links(F.col("text"), base))
    ).select(
        "row_key",
        "url_key",
        "day",
        F.struct("source_file", "source_offset", "pos").alias("_written"),
        F.col("col.target").alias("href"),
        F.col("col.anchor").alias("text"),
    )
    kept = links.filter((F.col("href") != "") & (F.col("text") != "") & ~F.col("href").startswith(MAIL))
    # Written once, so that the pages are not parsed again to look up the hosts they link to.
    last = cut_lineage(
        kept.groupBy("row_key", "url_key", "day", "href")
        .agg(F.max_by("text", "_written").alias("text"))
        .withColumn("host", host_name("href"))
    )
    return last.join(_marks(last, seeds, meta), "host", "left").select(
        "row_key",
        "url_key",
        "day",
        "href",
        clean_anchor("text").alias("anchor"),
        "code",
        F.coalesce("in_seeds", F.lit(False)).alias("in_seeds"),
    )
