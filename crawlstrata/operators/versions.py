"""Versions of a URL: identity, history, neighbours, spans, as-of lookup.

A capture time has whole seconds, so one URL has at most 3,600 distinct times in an hour and about
8,800 hours in a year. Windows here run over (URL, hour) times and over a URL's hours, never over all
captures of a URL: a URL that holds a large part of the archive is spread over its hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlstrata.functions.keys import url_key
from crawlstrata.operators.planes import rows_of_keys
from crawlstrata.session import stage

IDENTITY = ["url_key", "content_type", "capture_ts"]


def latest_write(captures: DataFrame) -> DataFrame:
    """One capture per (key, type, time): the last by source file and offset.

    Spark limits each input partition to one row per identity before the shuffle, so copies of one
    capture do not gather in a task.
    """
    order = Window.partitionBy(*IDENTITY).orderBy(F.desc("source_file"), F.desc("source_offset"))
    return captures.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


def capture_history(captures: DataFrame, url: str | None = None) -> DataFrame:
    """Distinct capture times ascending; of one URL if given (pushed to the scan), else of every key."""
    if url is not None:
        captures = captures.filter(F.col("url_key") == url_key(F.lit(url)))
    return captures.select("url_key", "capture_ts").distinct().orderBy("url_key", "capture_ts")


def hour_of(ts: str) -> Column:
    """Number of the UTC hour of a time, whatever the session's time zone."""
    return F.floor(F.unix_seconds(ts) / 3600)


def capture_times(captures: DataFrame) -> DataFrame:
    """Distinct (url_key, capture_ts) with their hour."""
    times = captures.filter(F.col("url_key").isNotNull() & F.col("capture_ts").isNotNull())
    return times.select("url_key", "capture_ts").distinct().withColumn("_hour", hour_of("capture_ts"))


def capture_nav(captures: DataFrame) -> DataFrame:
    """Previous and next capture time of each (url_key, capture_ts); the ends point to themselves."""
    times = capture_times(captures)
    hours = times.groupBy("url_key", "_hour").agg(F.min("capture_ts").alias("_first"), F.max("capture_ts").alias("_last"))
    by_hour = Window.partitionBy("url_key").orderBy("_hour")
    around = hours.select(
        "url_key", "_hour", F.lag("_last").over(by_hour).alias("_earlier"), F.lead("_first").over(by_hour).alias("_later")
    )
    inside = Window.partitionBy("url_key", "_hour").orderBy("capture_ts")
    return (
        times.withColumn("_prev", F.lag("capture_ts").over(inside))
        .withColumn("_next", F.lead("capture_ts").over(inside))
        .join(around, ["url_key", "_hour"])
        .select(
            "url_key",
            "capture_ts",
            F.coalesce("_prev", "_earlier", "capture_ts").alias("prev_ts"),
            F.coalesce("_next", "_later", "capture_ts").alias("next_ts"),
        )
    )


def capture_span(captures: DataFrame) -> DataFrame:
    """Number of captures, first and last capture time per key."""
    return captures.filter(F.col("url_key").isNotNull()).groupBy("url_key").agg(
        F.count(F.lit(1)).alias("captures"), F.min("capture_ts").alias("first_ts"), F.max("capture_ts").alias("last_ts")
    )


def latest_capture(captures: DataFrame) -> DataFrame:
    """The newest capture of every key; of captures at one time the last written.

    It is found on narrow columns and written as a table of places. Content is read where it lies and neither
    sorted, compared nor shuffled: the captures of these places are picked by `rows_of_keys`.
    """
    place = ["url_key", "capture_ts", "source_file", "source_offset"]
    known = captures.filter(F.col("url_key").isNotNull())
    newest = known.groupBy("url_key").agg(F.max(F.struct(*place[1:])).alias("_newest")).select("url_key", "_newest.*")
    return rows_of_keys(known, stage(newest))


def as_of(requests: DataFrame, captures: DataFrame) -> DataFrame:
    """Adds served_ts to requests (url_key, request_ts): the capture at that time, else the earliest
    after, else the latest; requests for keys never captured are dropped.

    Requests meet one row per (key, hour) that holds that hour's times, the first later time and the
    last time of all, so no request is paired with all captures of its key.
    """
    times = capture_times(captures)
    held = times.groupBy("url_key", "_hour").agg(
        F.array_sort(F.collect_set("capture_ts")).alias("_times"), F.min("capture_ts").alias("_first")
    )
    asked = requests.withColumn("_hour", hour_of("request_ts"))
    wanted = asked.select("url_key", "_hour").distinct()
    hours = held.unionByName(wanted, allowMissingColumns=True).groupBy("url_key", "_hour").agg(
        F.first("_times", ignorenulls=True).alias("_times"), F.min("_first").alias("_first")
    )
    # From the last hour down, so that each row's minimum is taken over from the row before.
    later = Window.partitionBy("url_key").orderBy(F.desc("_hour")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("url_key")
    answers = hours.select(
        "url_key",
        "_hour",
        "_times",
        F.min("_first").over(later).alias("_later"),
        F.max(F.element_at("_times", -1)).over(whole).alias("_last"),
    ).filter(F.col("_last").isNotNull())
    here = F.array_min(F.filter("_times", lambda t: t >= F.col("request_ts")))
    return asked.join(answers, ["url_key", "_hour"]).select(
        *requests.columns, F.coalesce(here, "_later", "_last").alias("served_ts")
    )
