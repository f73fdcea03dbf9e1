"""Numbering of URLs and lookups by URL, id and prefix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlstrata.operators.numbering import running_totals
from crawlstrata.session import stage

# The id of a URL that has none.
NO_ID = -1


def build_url_ids(urls: DataFrame, dense: bool = False) -> DataFrame:
    """(url, id) numbered from 1 in byte order.

    A repeated URL keeps its first number and uses up the rest; `dense` leaves no gaps.
    """
    counts = urls.groupBy("url").agg(F.count(F.lit(1)).alias("_count"))
    if dense:
        counts = counts.withColumn("_count", F.lit(1).cast("long"))
    return running_totals(counts, "url", "_count").select("url", (F.col("before") + 1).alias("id"))


def save_url_ids(url_ids: DataFrame, table: str, buckets: int, by: str = "url", path: str | None = None) -> DataFrame:
    """The ids as a table of `buckets` files by the hash of `by`, read back: joins on `by` leave it where it lies.

    For numbers that many jobs look up: they shuffle their own rows to the buckets and not the table. A `path` says where
    it lies, if not in the warehouse. With about 128 MB a bucket, a bucket is what one task of such a join reads.
    """
    rows = url_ids.select("url", "id").repartition(buckets, by)
    writer = rows.write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return url_ids.sparkSession.table(table)


def ids_in_use(urls: DataFrame, saved: DataFrame, buckets: int) -> DataFrame:
    """(url, id) of the distinct `urls` that have an id in a table of `save_url_ids`, which does not move.

    URLs are made distinct before they go to the buckets, as no bucket can be split: a URL that a third of all rows
    name comes there once. What is found is the table to look up in; write it first (`session.stage`), so that
    the look-up's own skewed keys can be split.
    """
    named = urls.select("url").filter(F.col("url").isNotNull()).distinct().repartition(buckets, "url")
    # A sort merge join, as a broadcast of the few that are asked for would read each bucket's file in any task.
    return saved.hint("merge").join(named, "url").select("url", "id")


def lookup_ids(urls: DataFrame, url_ids: DataFrame) -> DataFrame:
    """Adds id to urls, -1 where a URL has none."""
    return urls.join(url_ids.select("url", "id"), "url", "left").withColumn("id", F.coalesce("id", F.lit(NO_ID).cast("long")))


def lookup_urls(ids: DataFrame, url_ids: DataFrame) -> DataFrame:
    """Adds url to ids; ids without one are dropped."""
    return ids.join(url_ids.select("id", "url"), "id")


def prefix_search(url_ids: DataFrame, prefix: str) -> DataFrame:
    """URLs that begin with `prefix`, itself included, in byte order; the filter reaches the scan."""
    return url_ids.filter(F.col("url").startswith(prefix)).orderBy("url")


def leading_parts(text: Column, lengths: Column) -> Column:
    """The beginnings of `text` that have one of `lengths`."""
    return F.transform(F.filter(lengths, lambda n: n <= F.length(text)), lambda n: F.substring(text, 1, n))


def lengths_of(table: DataFrame, column: str) -> Column:
    """Distinct text lengths in a column, as a scalar: at most as many as its longest text has characters."""
    return table.agg(F.array_sort(F.collect_set(F.length(column)))).scalar()


def prefix_id_ranges(prefixes: DataFrame, url_ids: DataFrame, ordered: bool = True) -> DataFrame:
    """First and last id of the URLs under each prefix, null where there are none.

    Ids must rise with the URLs in byte order, as `build_url_ids` numbers them. Then a prefix needs two places in the
    order, before its first and after its last possible URL: URLs and places are sorted once together, each place
    takes the id next to it, and one over a border between ranges that of the nearest range with a URL. Ids in
    another order (`ordered` false) need every URL cut to every length that prefixes have.
    """
    ranges = _ranges_in_order(prefixes, url_ids) if ordered else _ranges_by_parts(prefixes, url_ids)
    return prefixes.join(ranges, F.col("id") == F.col("_prefix_id"), "left").select("id", "prefix", "start_id", "end_id")


def _ranges_by_parts(prefixes: DataFrame, url_ids: DataFrame) -> DataFrame:
    """Prefixes are parts of URLs: an equality join. A prefix of many URLs is a skewed key, which adaptive execution splits."""
    sized = url_ids.select("url", "id", lengths_of(prefixes, "prefix").alias("_lengths"))
    cut = sized.select(F.explode(leading_parts(F.col("url"), F.col("_lengths"))).alias("prefix"), "id")
    # The prefixes enter the join as they are: an aggregate on that side would keep it from being split.
    named = prefixes.select(F.col("id").alias("_prefix_id"), "prefix")
    return cut.join(named, "prefix").groupBy("_prefix_id").agg(F.min("id").alias("start_id"), F.max("id").alias("end_id"))


# Places in the order at one key: before the URL, the URL, after all URLs that begin with the key.
BEFORE, URL, AFTER = 0, 1, 2


def _ranges_in_order(prefixes: DataFrame, url_ids: DataFrame) -> DataFrame:
    key, none = F.col("prefix").cast("binary"), F.lit(None)
    wanted = prefixes.filter(F.col("prefix").isNotNull() & F.col("id").isNotNull())
    # No UTF-8 text has the byte FF, so it comes after all that can follow a prefix.
    places = [
        wanted.select(k.alias("_key"), F.lit(side).alias("_side"), none.cast("long").alias("_id"), F.col("id").alias("_prefix_id"), "prefix")
        for k, side in ((key, BEFORE), (F.concat(key, F.unhex(F.lit("FF"))), AFTER))
    ]
    urls = url_ids.filter(F.col("url").isNotNull() & F.col("id").isNotNull()).select(
        F.col("url").cast("binary").alias("_key"), F.lit(URL).alias("_side"), F.col("id").cast("long").alias("_id"),
        none.cast(places[0].schema["_prefix_id"].dataType).alias("_prefix_id"), none.cast("string").alias("prefix"),
    )
    merged = urls.unionByName(places[0]).unionByName(places[1]).repartitionByRange("_key", "_side").sortWithinPartitions("_key", "_side")
    told = merged.select("_side", "_id", "_prefix_id", "prefix")
    schema = told.select("_side", F.col("_id").alias("_near"), "_prefix_id", "prefix", none.cast("long").alias("_last"), F.lit(0).alias("_range")).schema

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The places with the id next to them in this range, and a row with the range's first and last id."""
        from pyspark import TaskContext

        part, first, last = TaskContext.get().partitionId(), None, None
        waiting: list[pa.RecordBatch] = []

        def row(rows: pa.RecordBatch, ids: pa.Array) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [rows.column(0), ids, rows.column(2), rows.column(3), pa.nulls(n, pa.int64()), pa.array(np.full(n, part, np.int32))], schema.names
            )

        kinds = None
        for batch in batches:
            kinds = batch.schema
            side = batch.column(0).to_numpy()
            n = len(side)
            at = np.flatnonzero(side == URL)
            ids = batch.column(1).to_numpy(zero_copy_only=False)[at].astype(np.int64)
            if len(at):
                for rows in waiting:
                    yield row(rows, pa.array(np.full(rows.num_rows, ids[0])))
                waiting = []
            after, before = np.flatnonzero(side == AFTER), np.flatnonzero(side == BEFORE)
            if len(after):
                k = np.searchsorted(at, after) - 1
                found = [int(ids[j]) if j >= 0 else last for j in k]
                yield row(batch.take(pa.array(after)), pa.array(found, pa.int64()))
            if len(before):
                k = np.searchsorted(at, before)
                met = k < len(at)
                yield row(batch.take(pa.array(before[met])), pa.array(ids[k[met]]))
                if not met.all():
                    waiting.append(batch.take(pa.array(before[~met])))
            if len(at):
                first, last = int(ids[0]) if first is None else first, int(ids[-1])
        for rows in waiting:
            yield row(rows, pa.nulls(rows.num_rows, pa.int64()))
        if kinds is not None:
            values = [URL, first, None, None, last, part]
            types = [pa.int32(), pa.int64(), kinds.field(2).type, pa.string(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], schema.names)

    carried = stage(told.mapInArrow(near, schema))
    down = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    up = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: never more than there are shuffle partitions.
    borders = carried.filter(F.col("_side") == URL).select(
        F.col("_range").alias("_at"),
        F.last("_near", ignorenulls=True).over(down).alias("_later"),
        F.last("_last", ignorenulls=True).over(up).alias("_earlier"),
    )
    around = carried.filter(F.col("_side") != URL).join(F.broadcast(borders), F.col("_range") == F.col("_at"), "left")
    of = lambda side, beyond: F.max(F.when(F.col("_side") == side, F.coalesce("_near", beyond)))
    ranges = around.groupBy("_prefix_id", "prefix").agg(of(BEFORE, "_later").alias("start_id"), of(AFTER, "_earlier").alias("end_id"))
    return ranges.filter("start_id <= end_id").groupBy("_prefix_id").agg(F.min("start_id").alias("start_id"), F.max("end_id").alias("end_id"))
