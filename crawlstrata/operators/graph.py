"""Links between pages and between sites."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from crawlstrata.functions.content import DEFAULT_CHARSET, decode_as
from crawlstrata.functions.keys import collapse_dot_segments, strip_blanks
from crawlstrata.operators.markup import BLOCKS, LINK_SCHEMES, links_of
from crawlstrata.operators.search import html_only
from crawlstrata.session import cut_lineage

_LINKS = ArrayType(StructType([StructField("target", StringType()), StructField("anchor", StringType())]))
_LINKS_ARROW = pa.list_(pa.struct([("target", pa.string()), ("anchor", pa.string())]))


@F.arrow_udf(_LINKS)
def parsed_links(html: pa.Array, url: pa.Array) -> pa.Array:
    """Anchors of each page as (target, anchor), read with an HTML parser."""
    found = [
        None if h is None else [{"target": t, "anchor": a} for t, a in links_of(h, u or "")]
        for h, u in zip(html.to_pylist(), url.to_pylist())
    ]
    return pa.array(found, type=_LINKS_ARROW)


# A URL's origin, its path, and the scheme of a link.
ORIGIN = "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
PATH = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
LINK_PATH = "^([^?#]*)"
LINK_SCHEME = "^([A-Za-z][A-Za-z0-9+.-]*):"


def _place(origin: Column, rest: Column) -> Column:
    """A URL of its origin and the rest, the path of which may hold dot segments."""
    path = F.regexp_extract(rest, LINK_PATH, 1)
    resolved = F.concat(origin, collapse_dot_segments(path), F.substr(rest, F.length(path) + 1))
    return F.when(path.contains("/."), resolved).otherwise(F.concat(origin, rest))


def resolve_url(base: Column, link: Column) -> Column:
    """`link` made absolute against `base`, null if its protocol is not one of a link."""
    origin, path = F.regexp_extract(base, ORIGIN, 1), F.regexp_extract(base, PATH, 1)
    folder = F.regexp_extract(path, "^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    written = F.regexp_extract(link, LINK_SCHEME, 1)
    lowered = F.concat(F.lower(written), F.substr(link, F.length(written) + 1))
    own = F.regexp_extract(lowered, ORIGIN, 1)
    whole = F.when(own == "", lowered).otherwise(_place(own, F.substr(lowered, F.length(own) + 1)))
    beside = F.concat(F.substring_index(base, ":", 1), F.lit(":"), F.regexp_extract(link, "^(//[^/?#]*)", 1))
    beside_rest = F.regexp_replace(link, "^//[^/?#]*", "")
    return (
        F.when(written != "", F.when(F.lower(written).isin(sorted(LINK_SCHEMES)), whole))
        .when(origin == "", None)
        .when(link == "", base)
        .when(link.startswith("//"), _place(beside, beside_rest))
        .when(link.startswith("#"), F.concat(F.substring_index(base, "#", 1), link))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .when(link.startswith("/"), _place(origin, link))
        .otherwise(_place(origin, F.concat(folder, link)))
    )


# A tag ends at the first > that is in no quoted value. Every loop is possessive and every tag is consumed, at the
# worst up to the end of the page, so that no part of a page is searched more than a few times.
_ATTRIBUTES = r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)|[\"'])*+"
_ANCHOR_TEXT = rf"[^<]*+(?:(?!</?a[\s/>])(?:<[a-z]{_ATTRIBUTES}(?:>|\z)|<)[^<]*+)*+"
_TAGS = rf"(?is)<a(?=[\s/>]){_ATTRIBUTES}(?:>{_ANCHOR_TEXT}|\z)|<[a-z]{_ATTRIBUTES}(?:>|\z)|<[!?/][^>]*+>?"
_UNQUOTED = rf"(?is)<a(?=[\s/>])[^>]*+(?:>{_ANCHOR_TEXT}|\z)"
_NAME, _VALUE = r"[^\s=>\"'/]++", r"(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)"
_HREF = rf"(?is)^<a(?:(?!href(?:[\s=>\"'/]|\z)){_NAME}(?:\s*+=\s*+{_VALUE})?+|[\s=>\"'/])*+href(?:\s*+=\s*+({_VALUE}))?+"
# Entities that plain markup may hold; the last one ends the decoding.
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def _decoded(text: Column) -> Column:
    for entity, character in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def _said(markup: Column) -> Column:
    """The text of an anchor: blocks part words, other tags do not."""
    block = rf"(?is)</?(?:{'|'.join(sorted(BLOCKS))})(?=[\s/>]){_ATTRIBUTES}>"
    text = F.regexp_replace(F.regexp_replace(markup, block, " "), rf"(?is)<[a-z]{_ATTRIBUTES}>|<[!?/][^>]*+>", "")
    return F.btrim(F.regexp_replace(_decoded(text), r"[ \t\n\r\f\x0B\xA0]+", " "), F.lit(" "))


def plain_links(html: Column, url: Column) -> Column:
    """Anchors of plain markup as (target, anchor) without Python, as the HTML parser finds them.

    Plain markup has no base element, no entity but those of _ENTITIES, no tag inside a title or text area and
    none that the end of the page cuts off.
    Where the quotes of a tag swallow the rest of the page, quotes count for nothing in that rest.
    """
    # What is never closed goes on to the end, so that no part of a page is searched more than once.
    unseen = "|".join(rf"<{name}\b(?:.*?</{name}\s*>|.*)" for name in ("script", "style"))
    visible = F.regexp_replace(html, rf"(?is)<!--(?:.*?-->|.*)|{unseen}", "")
    tags = F.regexp_extract_all(visible, F.lit(_TAGS), F.lit(0))
    is_anchor, no_links = r"(?i)^<a[\s/>]", F.array().cast("array<struct<tag:string,text:string>>")

    def parted(elements: Column, tag: str) -> Column:
        """The tag and the text of those that have an end."""
        whole = F.filter(elements, lambda e: F.rlike(e, F.lit(is_anchor)) & F.rlike(e, F.lit(f"{tag}>")))
        head = lambda e: F.regexp_extract(e, tag, 0)
        return F.transform(whole, lambda e: F.struct(head(e).alias("tag"), F.substr(e, F.length(head(e)) + 2).alias("text")))

    last = F.try_element_at(tags, F.lit(-1))
    rest = F.regexp_extract_all(F.when(F.rlike(last, F.lit(rf"(?is)^<[a-z]{_ATTRIBUTES}\z")), last), F.lit(_UNQUOTED), F.lit(0))
    found = F.concat(parted(tags, f"(?is)^<a{_ATTRIBUTES}"), F.coalesce(parted(rest, "(?is)^<a[^>]*+"), no_links))
    named = F.filter(found, lambda link: F.rlike(link["tag"], F.lit(_HREF)))
    value = lambda link: F.regexp_replace(F.regexp_extract(link["tag"], _HREF, 1), "^[\"']|[\"']$", "")
    return F.transform(
        named,
        lambda link: F.struct(
            resolve_url(url, strip_blanks(_decoded(value(link)))).alias("target"), _said(link["text"]).alias("anchor")
        ),
    )


def page_links(captures: DataFrame, charset: str = DEFAULT_CHARSET, parser: str = "html", mode: str = "exact") -> DataFrame:
    """One row per HTML capture with its links as an array of (target, anchor), in page order.

    `parser='html'` reads any markup in Python batches; `parser='plain'` stays in the JVM.
    """
    read = {"html": parsed_links, "plain": plain_links}[parser]
    pages = html_only(captures, mode)
    return pages.select(
        "source_file",
        "source_offset",
        "url_key",
        "url",
        "capture_ts",
        read(decode_as("content", charset), F.col("url")).alias("links"),
    )


def extract_links(captures: DataFrame, charset: str = DEFAULT_CHARSET, parser: str = "html", mode: str = "exact") -> DataFrame:
    """Every link of every HTML capture: (url, target, anchor), usable targets only."""
    pages = page_links(captures, charset, parser, mode)
    return (
        pages.select("source_file", "source_offset", "url_key", "url", "capture_ts", F.posexplode("links"))
        .select(
            "source_file",
            "source_offset",
            F.col("pos").alias("position"),
            "url_key",
            "url",
            "capture_ts",
            F.col("col.target").alias("target"),
            F.col("col.anchor").alias("anchor"),
        )
        .filter(F.coalesce("target", F.lit("")) != "")
    )


def page_targets(links: Column) -> Column:
    """Distinct usable targets of a page's links."""
    return F.array_distinct(F.filter(F.transform(links, lambda l: l["target"]), lambda t: t != ""))


def with_page_ids(pages: DataFrame, url_ids: DataFrame, name: str = "src") -> DataFrame:
    """Rows whose URL has an id, with it; others are dropped."""
    return pages.join(url_ids.select("url", F.col("id").alias(name)), "url")


def target_ids(links: DataFrame, url_ids: DataFrame, how: str = "inner", name: str = "dst") -> DataFrame:
    """Rows with the id of their `target`."""
    return links.join(url_ids.select(F.col("url").alias("target"), F.col("id").alias(name)), "target", how)


def page_graph(pages: DataFrame, url_ids: DataFrame) -> DataFrame:
    """(src, dst list) of each page of `page_links` whose URL has an id.

    Targets are made distinct inside the page before they are joined; those without an id are
    dropped, and a page left without targets keeps an empty list. Its stand-in target is unlike any
    URL and different for each page, so pages without links do not meet in one task.
    """
    page = ["source_file", "source_offset"]
    sources = with_page_ids(pages.select(*page, "url", "capture_ts", page_targets(F.col("links")).alias("_targets")), url_ids)
    stand_in = F.array(F.concat(F.lit("\t"), F.col("source_file"), F.lit("\t"), F.col("source_offset")))
    some = F.when(F.size("_targets") > 0, F.col("_targets")).otherwise(stand_in)
    edges = sources.select(*page, "src", "capture_ts", F.explode(some).alias("target"))
    return (
        target_ids(edges, url_ids, "left")
        .groupBy(*page, "src", "capture_ts")
        .agg(F.array_sort(F.collect_set("dst")).alias("dst"))
    )


def linked_urls(pages: DataFrame) -> DataFrame:
    """`url` of every page of `page_links` and of each of its targets, as often as they are named."""
    return pages.select("url").unionByName(pages.select(F.explode(page_targets(F.col("links"))).alias("url")))


def link_stats(captures: DataFrame, graph: DataFrame) -> DataFrame:
    """One row: records read, and links, where a page without any counts as one."""
    links = graph.agg(F.coalesce(F.sum(F.greatest(F.size("dst"), F.lit(1))), F.lit(0).cast("long"))).scalar()
    return captures.agg(F.count(F.lit(1)).alias("records")).select("records", links.alias("links"))


def latest_adjacency(graph: DataFrame) -> DataFrame:
    """(src, dst) of the last written page of each src."""
    written = F.struct("source_file", "source_offset")
    return graph.groupBy("src").agg(F.max_by("dst", written).alias("dst"))


def _level(start: str, end: str) -> Column:
    """The smallest power of two that is no shorter than a range of ids."""
    return F.ceil(F.log2(F.col(end) - F.col(start) + 1)).cast("int")


def sites_of_ids(rows: DataFrame, column: str, ranges: DataFrame, site: str, size: str | None = None) -> DataFrame:
    """`rows` with each site whose id range holds `column`, as an equality join on aligned blocks of ids.

    A range lies in at most two blocks of the power of two that its length is rounded up to. An id asks for its
    block at each power in use, 63 at most, so it meets only ranges whose length is like the block's: what
    it meets in vain is bounded by how ranges overlap, not by how many there are.
    """
    known = ranges.filter(F.col("start_id").isNotNull()).withColumn("_level", _level("start_id", "end_id"))
    levels = known.agg(F.array_sort(F.collect_set("_level"))).scalar()
    block = lambda c: F.call_function("shiftright", F.col(c), F.col("_level"))
    blocks = known.select(
        F.col("id").alias(site),
        *([F.length("prefix").alias(size)] if size else []),
        F.col("start_id").alias("_start"),
        F.col("end_id").alias("_end"),
        "_level",
        F.explode(F.array_distinct(F.array(block("start_id"), block("end_id")))).alias("_block"),
    )
    asked = rows.withColumn("_levels", levels).withColumn("_level", F.explode("_levels")).withColumn("_block", block(column))
    return asked.join(blocks, ["_level", "_block"]).filter(F.col(column).between(F.col("_start"), F.col("_end"))).drop(
        "_level", "_levels", "_block", "_start", "_end"
    )


def site_graph(adjacency: DataFrame, ranges: DataFrame) -> DataFrame:
    """(source, target, weight): links from pages of one site to distinct pages of another or itself.

    A page counts for every site whose range holds it, a target for the one with the longest prefix
    (then the lowest id). Links are added up per (source site, target page) before targets are placed,
    so a page everyone links to brings at most one row per site to that join. A src may have several
    rows if no target is in two of them. The ranges, one row per prefix, are written once for both ends.
    """
    ranges = cut_lineage(ranges)
    sources = sites_of_ids(adjacency.select("src", "dst"), "src", ranges, "source")
    counted = (
        sources.select("source", F.explode(F.array_distinct("dst")).alias("dst"))
        .groupBy("source", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    placed = sites_of_ids(counted, "dst", ranges, "target", "_size")
    nearest = F.max_by("target", F.struct(F.col("_size"), -F.col("target")))
    return (
        placed.groupBy("source", "dst", "n")
        .agg(nearest.alias("target"))
        .groupBy("source", "target")
        .agg(F.sum("n").alias("weight"))
    )
