"""Jobs where one key holds most rows: the joins are split, the results stay whole."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from crawlstrata.functions.keys import url_key
from crawlstrata.operators import graph, outlinks, text, urlids, versions
from crawlstrata.session import prepare

# Thresholds small enough for a test's rows to count as skew.
TINY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.shuffle.partitions": "6",
}


@pytest.fixture
def small(spark):
    with contextlib.ExitStack() as undo:
        for key, value in TINY.items():
            undo.callback(lambda k=key, v=spark.conf.get(key, None): spark.conf.unset(k) if v is None else spark.conf.set(k, v))
            spark.conf.set(key, value)
        yield prepare(spark)


def collect_with_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_target_is_split(small):
    n = 6000
    links = F.array(*[F.struct(t.alias("target"), F.lit("a").alias("anchor")) for t in (F.lit("http://hot.com/"), F.concat(F.lit("http://x.com/"), F.col("id").cast("string")))])
    pages = small.range(0, n, 1, 8).select(
        F.lit("f").alias("source_file"), F.col("id").alias("source_offset"), F.lit("k").alias("url_key"),
        F.concat(F.lit("http://p.com/"), F.col("id").cast("string")).alias("url"), F.lit(dt.datetime(2004, 1, 1)).alias("capture_ts"), links.alias("links"))
    urls = pages.select("url").unionByName(small.createDataFrame([("http://hot.com/",)], "url string"))
    ids = urlids.build_url_ids(urls)
    rows, plan = collect_with_plan(graph.page_graph(pages, ids))
    assert len(rows) == n and all(r.dst == [1] for r in rows)
    assert "skew=true" in plan


def test_hot_prefix_is_split(small):
    n = 8000
    urls = small.range(0, n, 1, 8).select(F.concat(F.lit("http://hot.com/"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("url"), (F.col("id") + 1).alias("id"))
    prefixes = small.createDataFrame([(1, "http://hot.com/"), (2, "http://hot.com/000001"), (3, "x")], "id long, prefix string")
    want = {(1, "http://hot.com/", 1, n), (2, "http://hot.com/000001", 2, 2), (3, "x", None, None)}
    rows, plan = collect_with_plan(urlids.prefix_id_ranges(prefixes, urls, ordered=False))
    assert {tuple(r) for r in rows} == want
    assert "skew=true" in plan
    # By places in the order there is no key to be frequent.
    assert {tuple(r) for r in urlids.prefix_id_ranges(prefixes, urls).collect()} == want


def test_hot_url_requests_are_split(small):
    n = 8000
    start = dt.datetime(2004, 1, 1)
    captures = small.createDataFrame([("http://hot.com/", start), ("http://hot.com/", start + dt.timedelta(minutes=30)), ("http://a.com/", start)], "url string, capture_ts timestamp").withColumn("url_key", url_key("url"))
    requests = small.range(0, n, 1, 8).select("id", F.lit("com.hot/").alias("url_key"), F.timestamp_seconds(F.lit(int(start.replace(tzinfo=dt.timezone.utc).timestamp())) + F.col("id") % 3600).alias("request_ts"))
    rows, plan = collect_with_plan(versions.as_of(requests, captures))
    assert len(rows) == n
    assert all(r.served_ts == (start if r.id % 3600 == 0 else start + dt.timedelta(minutes=30)) for r in rows)
    assert "skew=true" in plan


def hot_captures(small, n, content):
    """Captures most of which are of one URL."""
    hot = F.when(F.col("id") % 10 < 7, F.lit("http://www.hot.com/p")).otherwise(F.concat(F.lit("http://x.com/"), F.col("id").cast("string")))
    ts = F.timestamp_seconds(F.lit(1074915780) + F.col("id"))
    return small.range(0, n, 1, 8).select(
        F.lit("f").alias("source_file"), F.col("id").alias("source_offset"), hot.alias("url"), url_key(hot).alias("url_key"), ts.alias("capture_ts"),
        F.date_format(ts, "yyyyMMddHHmmss").alias("capture_date"), F.lit("text/html").alias("content_type"), content.cast("binary").alias("content"),
        F.create_map(F.lit("content-type"), F.lit("text/html")).alias("http_headers"))


def test_hot_url_text_is_split(small):
    n = 3000
    captures = hot_captures(small, n, F.concat(F.lit("<p>"), F.col("id").cast("string")))
    rows, plan = collect_with_plan(text.extract_text(captures, small.createDataFrame([("hot",), ("com.x",)], "site_id string")))
    assert len(rows) == n and sum(r.site_id == "hot" for r in rows) == n * 7 // 10
    assert "skew=true" in plan


def test_hot_host_outlinks_are_split(small):
    n = 3000
    link = F.concat(F.lit('<a href="http://b.com/'), F.col("id").cast("string"), F.lit('">t</a><a href="http://c'), F.col("id").cast("string"), F.lit('.com/">u</a>'))
    seeds = small.createDataFrame([("b.com",)], "host string")
    meta = small.createDataFrame([("U1", "http://b.com/", "", 1)], "code string, url string, approved string, line_no long")
    rows, plan = collect_with_plan(outlinks.extract_outlinks(hot_captures(small, n, link), seeds, meta))
    assert len(rows) == 2 * n and sum((r.code, r.in_seeds) == ("U1", True) for r in rows) == n
    assert "skew=true" in plan
