"""URLs judged by a list of canonical URLs.

A blocked Bloom filter of the listed (host, path) pairs is tested with every host suffix and path prefix
of a URL. What it lets through may be listed: an exact hash join with the list removes the false ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlstrata.llm.exactdedup import filter_words, places, plane_of
from crawlstrata.llm.linededup import LOWER, UPPER
from crawlstrata.session import stage


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, ASCII letters in lower case; else empty."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: str, path: str) -> bytes:
    from hashlib import md5

    return md5(f"{host}\n{path}".encode("utf-8", "surrogatepass")).digest()


def list_filter(
    listed: DataFrame, rows: int, bits_per_row: int, max_bytes: int
) -> tuple[np.ndarray, list[int], frozenset[int]]:
    """A blocked Bloom filter of the listed pairs, and the lengths that their paths and hosts have."""
    digest = F.unhex(F.md5(F.concat_ws("\n", "_host", "_path")))
    plane = plane_of(listed.select(digest.alias("digest")), filter_words(rows, bits_per_row, max_bytes))
    # Distinct lengths, so at most as many as the longest path has characters.
    paths, hosts = (sorted(r[0] for r in listed.select(F.char_length(c)).distinct().collect()) for c in ("_path", "_host"))
    return plane, paths, frozenset(hosts)


def suffixes(host: str, sizes: frozenset[int]) -> list[str]:
    """The host and its parents, as far as their lengths are listed."""
    starts = [0, *(i + 1 for i, c in enumerate(host) if c == ".")]
    return [host[s:] for s in starts if len(host) - s in sizes]


def candidates(urls: DataFrame, plane: np.ndarray, paths: list[int], hosts: frozenset[int]) -> DataFrame:
    """`urls` (with `_host`, `_path`) with `_hits`: the pairs of suffix and prefix that may be listed."""
    words = len(plane)
    held = urls.sparkSession.sparkContext.broadcast((plane, paths, hosts))
    at_host, at_path = urls.columns.index("_host"), urls.columns.index("_path")
    kind = "array<struct<host: string, path: string>>"
    hit_type = pa.list_(pa.struct([("host", pa.string()), ("path", pa.string())]))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, path_sizes, host_sizes = held.value
        for batch in batches:
            pairs, owner = [], []
            for i, (host, path) in enumerate(zip(*(batch.column(c).to_pylist() for c in (at_host, at_path)), strict=True)):
                ends = [n for n in path_sizes if n <= len(path)]
                for suffix in suffixes(host, host_sizes):
                    pairs += [(suffix, path[:n]) for n in ends]
                    owner += [i] * len(ends)
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            if pairs:
                at = places([_digest(*p) for p in pairs], words)
                seen = ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)
                for j in np.flatnonzero(seen):
                    hits[owner[j]].append({"host": pairs[j][0], "path": pairs[j][1]})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, hit_type)], [*batch.schema.names, "_hits"])

    return urls.mapInArrow(probe, urls.withColumn("_hits", F.array().cast(kind)).schema)


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    id: str = "page_id",
    url: str = "url",
    otherwise: str = "allow",
    bits_per_row: int = 16,
    max_filter_bytes: int = 32 << 20,
) -> DataFrame:
    """One row per row of `pages`: `id`, `host`, `path`, `rule`, `verdict`, and `entry`, what decided.

    `listed` has the columns `host`, `path`, `verdict` and, if it names them, `rule` (true: an entry is
    reported as the rule it is). An entry fits its host and all subdomains where the URL's path starts
    with the entry's. Of the fitting rules the longest wins (host and path together, then the longer host);
    without a rule the longest fitting entry that is no rule decides, else `otherwise`. Repeated entries
    count once, `block` before `allow`. A null URL and one without `://` have an empty host and path and
    fit entries with an empty host only. Repeated rows and null ids are judged like others; empty tables
    give no rows, an empty list leaves every URL to `otherwise`. Other columns are not read.

    The filter has `bits_per_row` bits per entry and at most `max_filter_bytes`; a longer list makes more
    false hits, which the join removes. Only URLs with hits are shuffled, once as distinct (host, path)
    with their hits and once to take the verdict; the list is written first, so that Spark knows its size
    and splits the rows of a hot entry. Of URLs without a hit nothing moves.
    """
    has_rule = "rule" in listed.columns
    entries = stage(
        listed.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
        .groupBy(F.col("host").alias("_host"), F.col("path").alias("_path"))
        .agg(F.max("verdict").alias("_verdict"), (F.max("rule") if has_rule else F.lit(False)).alias("_rule"))
    )
    plane, *sizes = list_filter(entries, entries.count(), bits_per_row, max_filter_bytes)
    urls = pages.select(F.col(id).alias("_id"), host_of(F.col(url)).alias("_host"), path_of(F.col(url)).alias("_path"))
    probed = stage(candidates(urls, plane, *sizes))
    possible = probed.filter(F.size("_hits") > 0)
    # Ranks first by rule, then by length; the strings of the entry come last, so the order is total.
    rank = F.struct(
        F.col("_rule"), F.char_length("e._host") + F.char_length("e._path"), F.char_length("e._host"),
        F.concat("e._host", "e._path").alias("_entry"), F.col("_verdict"),
    )
    exploded = possible.dropDuplicates(["_host", "_path"]).select("_host", "_path", F.explode("_hits").alias("_hit"))
    found = stage(
        exploded.alias("u")
        .join(entries.alias("e"), (F.col("_hit.host") == F.col("e._host")) & (F.col("_hit.path") == F.col("e._path")))
        .groupBy(F.col("u._host").alias("_h"), F.col("u._path").alias("_p"))
        .agg(F.max(rank).alias("_best"))
        .select("_h", "_p", F.col("_best._rule").alias("_rule"), F.col("_best._entry").alias("_entry"), F.col("_best._verdict").alias("_verdict"))
    )
    hit = possible.join(found, (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")), "left")
    free = probed.filter(F.size("_hits") == 0).withColumns(
        {"_rule": F.lit(None).cast("boolean"), "_entry": F.lit(None).cast("string"), "_verdict": F.lit(None).cast("string")}
    )
    columns = ["_id", "_host", "_path", "_rule", "_entry", "_verdict"]
    return hit.select(columns).unionByName(free.select(columns)).select(
        F.col("_id").alias(id),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.when(F.col("_rule"), F.col("_entry")).alias("rule"),
        F.coalesce("_verdict", F.lit(otherwise)).alias("verdict"),
        F.col("_entry").alias("entry"),
    )
