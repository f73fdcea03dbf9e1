"""Loading captures into a table sorted by key.

A table is a folder with one subfolder per load, `load=number-suffix`: the number rises, the suffix is unique, so
loads made at once keep apart and go by name. A load is written once and never changed; of captures with one
identity the last load's counts. So an append costs what it adds, and one that is repeated shows nothing new. Beside
the loads lie small files that Spark does not list: the bounds of each load's keys and times, which tell loads
that cannot share an identity, and the first load that counts, after the table was replaced.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from crawlstrata.operators.numbering import running_totals
from crawlstrata.operators.planes import KEY_BITS, MAX_PLANE_BYTES, may_hold
from crawlstrata.operators.versions import IDENTITY
from crawlstrata.session import stage

# A content limit that crawls are often loaded with (inclusive), type of captures that name
# none, record type loaded.
MAX_CONTENT_BYTES = 1024 * 1024
DEFAULT_TYPE = "text/plain"
LOADED_RECORD_TYPE = "response"

# The Parquet writer's names for a filter of a column's values in each row group, sized by what is there.
FILTERED = {"parquet.bloom.filter.enabled#url": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
GROUP_SIZE = "parquet.block.size"

# What content is written with, staged and in a table: some two thirds of the bytes of the writer's own choice.
COMPRESSED = {"compression": "zstd"}

# Of captures with content, those that others replace stay behind where they are this share at least.
REPLACED_SHARE = 0.1
# An identity with more captures than this in one load is thinned out before it is shuffled.
FREQUENT = 1000
# Files beside the loads, and characters of a key that a bound keeps.
BOUNDS, FIRST = "_bounds-", "_first-"
BOUND_CHARS = 1000


def load_reason(max_bytes: int | None = None) -> Column:
    """Why a record is loaded or not; every record has exactly one reason. Nothing is too large without a limit."""
    length = F.coalesce("content_length", F.octet_length("content"))
    too_large = F.lit(False) if max_bytes is None else length > max_bytes
    return (
        F.when(F.col("url_key").isNull(), "no_key")
        .when(F.coalesce(F.lower("record_type"), F.lit("")) != LOADED_RECORD_TYPE, "not_response")
        .when(length.isNull(), "no_content")
        .when(too_large, "too_large")
        .when(F.col("capture_ts").isNull(), "bad_date")
        .otherwise("inserted")
    )


def loadable(captures: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """The captures a load keeps, with the default type filled in."""
    return captures.filter(load_reason(max_bytes) == "inserted").withColumn(
        "content_type", F.coalesce("content_type", F.lit(DEFAULT_TYPE))
    )


def ingest_report(captures: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Records per reason."""
    return captures.groupBy(load_reason(max_bytes).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


def sorted_by_key(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """Captures in ranges of (key, time), sorted inside each; a frequent key spans several ranges."""
    ranged = (
        captures.repartitionByRange("url_key", "capture_ts")
        if partitions is None
        else captures.repartitionByRange(partitions, "url_key", "capture_ts")
    )
    return ranged.sortWithinPartitions("url_key", "capture_ts")


def _folder(spark: SparkSession, path: str):
    """The file system of `path`, and the path as that knows it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def loads_of(spark: SparkSession, path: str) -> list[str]:
    """Names of the loads that count, in the order they were made."""
    names = _names(spark, path)
    first = max((n.removeprefix(FIRST) for n in names if n.startswith(FIRST)), default="")
    return sorted(n.removeprefix("load=") for n in names if n.startswith("load=") and n.removeprefix("load=") >= first)


def _put(spark: SparkSession, path: str, text: str = "") -> None:
    """Write a small file as a whole: under another name first, as readers may come at any time."""
    files, file = _folder(spark, path)
    part = file.suffix(f".{uuid.uuid4().hex}")
    out = files.create(part, True)
    out.write(text.encode())
    out.close()
    files.delete(file, False)
    files.rename(part, file)


def last_of_frequent(captures: DataFrame) -> DataFrame:
    """The captures without those that a later one replaces, where an identity has more than FREQUENT.

    They are found on narrow columns and counted before they are shuffled; there are few such identities.
    """
    place = F.struct("source_file", "source_offset")
    counted = captures.groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("_n"), F.max(place).alias("_last"))
    frequent = stage(counted.filter(F.col("_n") > FREQUENT).drop("_n"))
    if frequent.isEmpty():
        return captures
    same = [captures[c].eqNullSafe(frequent[c]) for c in IDENTITY]
    kept = captures.join(frequent.select(*IDENTITY, "_last"), same, "left")
    return kept.filter(F.col("_last").isNull() | (place_of(captures) == F.col("_last"))).select(*[captures[c] for c in captures.columns])


def without_replaced(captures: DataFrame) -> DataFrame:
    """The captures without nearly all of those that a later one replaces, so that their content is not shuffled.

    The last ones are found on narrow columns, and a bit plane of their identities and places is held against the
    captures where they lie; what it lets through in vain is dropped in the ranges. `captures` should be a written table.
    """
    counted = captures.groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("n"), F.max(place_of(captures)).alias("_last"))
    last = stage(counted.select("n", F.xxhash64(*IDENTITY, "_last.source_file", "_last.source_offset").alias("_hash")))
    kept, read = last.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not read or read - kept < read * REPLACED_SHARE:
        return last_of_frequent(captures)
    hashed = captures.withColumn("_hash", F.xxhash64(*IDENTITY, "source_file", "source_offset"))
    likely = hashed.filter(may_hold(last, ["_hash"], kept)).drop("_hash")
    # A plane with too little room lets more through.
    return likely if kept * KEY_BITS <= MAX_PLANE_BYTES * 8 else last_of_frequent(likely)


def place_of(captures: DataFrame) -> Column:
    return F.struct(captures["source_file"], captures["source_offset"])


def one_per_identity(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """One capture per (key, type, time), the last by source file and offset, in ranges of (key, time) and sorted.

    Captures of one identity are in one range, where the same order that the table has puts them side by
    side; so captures are shuffled and sorted once. Read archives are written first: they are decoded once.
    """
    return _last_in_ranges(last_of_frequent(captures), partitions)


def _last_in_ranges(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    ranged = sorted_by_key(captures, partitions)
    order = Window.partitionBy("url_key", "capture_ts", "content_type").orderBy(F.desc("source_file"), F.desc("source_offset"))
    return ranged.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def _write_load(
    captures: DataFrame, path: str, partitions: int | None = None, tag: str | None = None, group_bytes: int | None = None
) -> str:
    """Write loadable captures as the next load. A load with the same `tag` is written again in its place.

    The bounds are taken as the rows are written. Until they are there, the load counts as unbounded. Keys are in
    order, so their row groups are told by first and last key; of URLs each row group has a filter.
    """
    spark = captures.sparkSession
    names = [n.removeprefix("load=") for n in _names(spark, path) if n.startswith("load=")]
    again = [n for n in names if tag is not None and n.endswith(f".{tag}")]
    number = 1 + max((int(n[1:10]) for n in names), default=0)
    name = again[0] if again else f"n{number:09d}-{uuid.uuid4().hex[:12]}" + (f".{tag}" if tag else "")
    if again:
        files, file = _folder(spark, f"{path}/{BOUNDS}{name}")
        files.delete(file, False)
    seen = Observation()
    millis = F.unix_millis("capture_ts")
    ends = [F.min("url_key").alias("k0"), F.max("url_key").alias("k1"), F.min(millis).alias("t0"), F.max(millis).alias("t1")]
    rows = _last_in_ranges(without_replaced(stage(captures, **COMPRESSED)), partitions).observe(seen, *ends)
    sized = {} if group_bytes is None else {GROUP_SIZE: str(group_bytes)}
    rows.write.options(**FILTERED, **COMPRESSED, **sized).mode("overwrite" if again else "errorifexists").parquet(f"{path}/load={name}")
    low, high = seen.get["k0"], seen.get["k1"]
    if low is not None:
        cut = high if len(high) <= BOUND_CHARS else high[:BOUND_CHARS] + "\U0010ffff"
        _put(spark, f"{path}/{BOUNDS}{name}", json.dumps([low[:BOUND_CHARS], cut, seen.get["t0"], seen.get["t1"]]))
    return name


def _replace(captures: DataFrame, path: str, partitions: int | None = None, group_bytes: int | None = None) -> None:
    """Write a load and let it be the first that counts, in one step; then delete what is older."""
    spark = captures.sparkSession
    first = _write_load(captures, path, partitions, group_bytes=group_bytes)
    _put(spark, f"{path}/{FIRST}{first}")
    files, folder = _folder(spark, path)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if any(name.startswith(kind) and name.removeprefix(kind) < first for kind in ("load=", BOUNDS, FIRST)):
            files.delete(status.getPath(), True)


def bulk_load(
    captures: DataFrame, path: str, partitions: int | None = None, max_bytes: int | None = None, group_bytes: int | None = None
) -> None:
    """Write loadable captures, one per identity, as Parquet in `partitions` ranges of keys; replaces the table.

    Row groups of about `group_bytes` (the writer's own size if None) are what a look-up of one URL reads.
    """
    _replace(loadable(captures, max_bytes), path, partitions, group_bytes)


def append_load(captures: DataFrame, path: str, max_bytes: int | None = None, tag: str | None = None) -> None:
    """Add the loadable captures as one load; the table is made if missing. Nothing in the table is read."""
    _write_load(loadable(captures, max_bytes), path, tag=tag)


def ingest(captures: DataFrame, path: str, mode: str, max_bytes: int | None = None) -> None:
    """Load captures into the table at `path`: `create` replaces it, `append` adds to it."""
    if mode == "create":
        bulk_load(captures, path, max_bytes=max_bytes)
    elif mode == "append":
        append_load(captures, path, max_bytes)
    else:
        raise ValueError(mode)


def _bounds(spark: SparkSession, path: str, loads: list[str]) -> dict[str, list | None]:
    """First and last key and time of each load; None where they are not known."""
    jvm, known = spark.sparkContext._jvm, set(_names(spark, path))
    out: dict[str, list | None] = dict.fromkeys(loads)
    for load in loads:
        if f"{BOUNDS}{load}" in known:
            files, file = _folder(spark, f"{path}/{BOUNDS}{load}")
            stream = files.open(file)
            out[load] = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
    return out


def _meet(a: list | None, b: list | None) -> bool:
    return a is None or b is None or (a[0] <= b[1] and b[0] <= a[1] and a[2] <= b[3] and b[2] <= a[3])


def _within(bounds: list | None) -> Column:
    """Whether a capture lies in the bounds; the comparisons reach the scan."""
    if bounds is None:
        return F.lit(True)
    low, high, first, last = bounds
    times = [F.timestamp_millis(F.lit(t)) for t in (first, last)]
    return F.col("url_key").between(low, high) & F.col("capture_ts").between(*times)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Captures of a loaded table, each identity once, as the last load wrote it.

    Loads whose keys or times lie apart from those of all others are read as they are. Of the rest, only the
    identities inside the bounds of another load are compared, and those written again are left out by a join
    with what replaces them, so content is not shuffled while the replaced captures are few.
    """
    loads = loads_of(spark, path)
    bounds = _bounds(spark, path, loads)
    others = {a: [b for b in loads if b != a and _meet(bounds[a], bounds[b])] for a in loads}
    # Without a load, reading says that there is no table.
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/load={n}" for n in loads] or [path])
    columns = [c for c in rows.columns if c != "load"]
    mixed = [n for n in loads if others[n]]
    if not mixed:
        return rows.select(*columns)
    shared = reduce(or_, [(F.col("load") == n) & reduce(or_, [_within(bounds[m]) for m in others[n]]) for n in mixed])
    order = Window.partitionBy(*IDENTITY).orderBy(F.desc("load"))
    place = ["load", "source_file", "source_offset"]
    compared = rows.filter(F.col("load").isin(mixed)).filter(shared).select(*IDENTITY, *place)
    replaced = compared.withColumn("_n", F.row_number().over(order)).filter("_n > 1").select(*IDENTITY, "load")
    kept = rows.filter(F.col("load").isin(mixed)).join(replaced, [*IDENTITY, "load"], "left_anti").select(*columns)
    return rows.filter(~F.col("load").isin(mixed)).select(*columns).unionByName(kept)


def compact(spark: SparkSession, path: str) -> None:
    """Rewrite a table as one load without what later loads replaced."""
    _replace(read_table(spark, path), path)


def key_histogram(captures: DataFrame) -> DataFrame:
    """Captures per first character of the key ('' for keys of one character or none)."""
    first = F.when(F.length("url_key") > 1, F.substring("url_key", 1, 1)).otherwise("")
    return captures.filter(F.col("url_key").isNotNull()).groupBy(first.alias("first_char")).agg(
        F.count(F.lit(1)).alias("captures")
    )


def split_points(captures: DataFrame, n: int) -> DataFrame:
    """Keys at which to split the table into `n` ranges of about equal capture counts.

    A range starts at the first key whose earlier captures reach its share; a key too frequent for
    one range swallows the boundaries inside it.
    """
    counts = captures.filter(F.col("url_key").isNotNull()).groupBy("url_key").agg(F.count(F.lit(1)).alias("captures"))
    placed = running_totals(counts, "url_key", "captures")
    part = F.floor(F.col("before") * F.lit(n) / F.col("total")).cast("int")
    return placed.groupBy(part.alias("part")).agg(F.min("url_key").alias("boundary")).filter("part > 0")
