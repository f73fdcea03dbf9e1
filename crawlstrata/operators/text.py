"""Text, replay copies and site membership of captures."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from crawlstrata.functions import content
from crawlstrata.functions.keys import base_path
from crawlstrata.operators.markup import replay_copy, text_of
from crawlstrata.operators.patterns import MAX_AUTOMATON_CHARS, sole_string
from crawlstrata.operators.search import distinct_urls, html_only
from crawlstrata.session import cut_lineage


# Tasks that write one site's text.
WRITERS = 64


@F.arrow_udf(StringType())
def visible_text(html: pa.Array) -> pa.Array:
    """Text of each page as a reader sees it, blanks and line breaks made one space."""
    return pa.array([None if h is None else text_of(h) for h in html.to_pylist()], type=pa.string())


@F.arrow_udf(StringType())
def replay_html(html: pa.Array, url: pa.Array, prefix: pa.Array) -> pa.Array:
    """Each page with its links led through its prefix."""
    rows = zip(html.to_pylist(), url.to_pylist(), prefix.to_pylist())
    return pa.array([None if h is None else replay_copy(h, u or "", p) for h, u, p in rows], type=pa.string())


def site_of_key(
    keys: DataFrame, site_ids: DataFrame, span: int | None = None, max_chars: int = MAX_AUTOMATON_CHARS
) -> DataFrame:
    """(url_key, site_id) of distinct keys that hold exactly one of the ids, in their first `span` characters if given.

    Ids of up to `max_chars` characters in all are an automaton in each task, which reads every key once; of
    more, only the places of a key where an id may begin are joined to the ids.
    """
    return sole_string(distinct_urls(keys), site_ids.select("site_id"), span, max_chars)


def site_base_paths(captures: DataFrame, site_ids: DataFrame, span: int | None = None) -> DataFrame:
    """(site_id, base, n): base paths of each site by number of distinct keys, most frequent first."""
    sites = site_of_key(captures, site_ids, span)
    counted = sites.groupBy("site_id", base_path("url_key").alias("base")).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("site_id", F.desc("n"), "base")


def extract_text(captures: DataFrame, site_ids: DataFrame, charset: str = "UTF-8", span: int | None = None) -> DataFrame:
    """(site_id, url_key, capture_date, file_name, text) of the HTML captures of keys with one site.

    The sites are written once: a join with an aggregate on its own key could not be split for a URL
    that most captures are of.
    """
    sites = cut_lineage(site_of_key(captures, site_ids, span))
    pages = html_only(captures, "contains").join(sites, "url_key")
    return pages.select(
        "site_id",
        "url_key",
        "capture_date",
        content.key_file_name("capture_date", "url_key").alias("file_name"),
        visible_text(content.decode_as("content", charset)).alias("text"),
    )


def write_text(texts: DataFrame, path: str) -> None:
    """Extracted text as Parquet, one folder per site id; a site is spread over WRITERS tasks at most."""
    spread = F.pmod(F.hash("url_key"), F.lit(WRITERS))
    texts.repartition("site_id", spread).write.mode("overwrite").partitionBy("site_id").parquet(path)


def strip_tags(captures: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """Adds `text`: content without anything between < and >."""
    return captures.withColumn("text", content.strip_tags(content.decode_as("content", charset)))


def rewrite_links(captures: DataFrame, server: str, archive: str, charset: str = "UTF-8") -> DataFrame:
    """Replay copies of text captures but plain text: links become server + archive / milliseconds / URL."""
    prefix = F.concat(
        F.lit(f"{server}{archive}/"), F.unix_millis("capture_ts").cast("string"), F.lit("/")
    )
    text = content.decode_as("content", charset)
    kind = F.col("content_type")
    return captures.filter(kind.startswith("text") & ~kind.startswith("text/plain")).select(
        "url_key", "url", "capture_ts", replay_html(text, F.col("url"), prefix).alias("html")
    )
