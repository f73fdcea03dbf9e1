"""Jobs on small hand-made captures, against plain Python where the rule is easier said there."""

import datetime as dt
import itertools
import os
import random
import time
from collections import Counter

import pyarrow.parquet as pq
import pytest
from archive_files import arc_file, arc_record, http
from pyspark.sql import functions as F

from crawlstrata.functions.keys import url_key
from crawlstrata.operators import counts, graph, ingest, numbering, outlinks, search, text, urlids, versions
from crawlstrata.session import stage as cut
from crawlstrata.streaming.increment import ingest_increment

T0 = dt.datetime(2004, 1, 24, 3, 43)
SCHEMA = ("url string, capture_ts timestamp, content_type string, content binary, source_file string, "
          "source_offset long, record_type string")


def make(spark, rows):
    """Captures of (url, seconds after T0, type, content)."""
    data = [(u, T0 + dt.timedelta(seconds=s), k, c, "f", i, "response") for i, (u, s, k, c) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("url_key", url_key("url"))
    return df.withColumn("capture_date", F.date_format("capture_ts", "yyyyMMddHHmmss")).withColumn(
        "content_length", F.octet_length("content").cast("long"))


def many(seed=0, n=400):
    """Captures where one URL has most rows, over hours and days."""
    rnd = random.Random(seed)
    urls = ["http://hot.com/"] * 6 + ["http://a.com/x", "http://b.com/y", "http://c.com"]
    return [(rnd.choice(urls), rnd.choice([rnd.randrange(40), rnd.randrange(90000), rnd.randrange(9000000)]),
             rnd.choice(["text/html", "text/plain", None]), rnd.choice([b"a", b"b", b"cc"])) for _ in range(n)]


def seconds(ts):
    return None if ts is None else int((ts - T0).total_seconds())


def test_latest_write(spark):
    rows = many()
    got = versions.latest_write(make(spark, rows)).collect()
    want = {}
    for i, (u, s, k, _) in enumerate(rows):
        want[u, s, k] = i
    assert {(r.url, seconds(r.capture_ts), r.content_type): r.source_offset for r in got} == want
    assert len(got) == len(want)


def test_navigation_matches_brute_force(spark):
    rows = many(1)
    got = {(r.url_key, seconds(r.capture_ts)): (seconds(r.prev_ts), seconds(r.next_ts))
           for r in versions.capture_nav(make(spark, rows)).collect()}
    times = {}
    for u, s, _, _ in rows:
        times.setdefault(u, set()).add(s)
    want = {}
    for u, found in times.items():
        key = ".".join(reversed(u.split("/")[2].split("."))) + u[len("http://") + len(u.split("/")[2]):]
        order = sorted(found)
        for i, s in enumerate(order):
            want[key, s] = (order[max(i - 1, 0)], order[min(i + 1, len(order) - 1)])
    assert got == want


def test_as_of_matches_brute_force(spark):
    rows, rnd = many(2), random.Random(3)
    captures = make(spark, rows)
    asked = [(i, rnd.choice(["com.hot/", "com.a/x", "com.none/"]), rnd.choice([rnd.randrange(-500, 9100000), rnd.randrange(60)]))
             for i in range(300)]
    requests = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, k, s in asked], "id int, url_key string, request_ts timestamp")
    got = {r.id: seconds(r.served_ts) for r in versions.as_of(requests, captures).collect()}
    want = {}
    for i, k, s in asked:
        times = sorted(t for u, t, _, _ in rows if u == {"com.hot/": "http://hot.com/", "com.a/x": "http://a.com/x"}.get(k))
        if times:
            want[i] = next((t for t in times if t >= s), times[-1])
    assert got == want


def test_request_before_first_capture_gets_the_first(spark):
    captures = make(spark, [("http://a.com/x", 10, "t", b""), ("http://a.com/x", 20, "t", b"")])
    requests = spark.createDataFrame([("com.a/x", T0)], "url_key string, request_ts timestamp")
    assert seconds(versions.as_of(requests, captures).first().served_ts) == 10


def test_history_span_latest(spark):
    captures = make(spark, [("http://a.com/x", 20, "t", b"1"), ("http://a.com/x", 10, "t", b"2"), ("https://a.com/x", 20, "u", b"3")])
    assert [seconds(r.capture_ts) for r in versions.capture_history(captures, "http://a.com/x#y").collect()] == [10, 20]
    assert versions.capture_history(captures, "http://none.com/").count() == 0
    span = versions.capture_span(captures).first()
    assert (span.captures, seconds(span.first_ts), seconds(span.last_ts)) == (3, 10, 20)
    assert bytes(versions.latest_capture(captures).first().content) == b"3"


def test_history_reads_one_key_range(spark, tmp_path):
    ingest.ingest(make(spark, many(4)), str(tmp_path / "t"), "create")
    plan = versions.capture_history(spark.read.parquet(str(tmp_path / "t")), "http://a.com/x")
    text_of_plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(url_key,com.a/x)" in text_of_plan and "content:binary" not in text_of_plan


@pytest.mark.parametrize("scope", ["all_captures", "latest_per_type"])
def test_duplicates_match_pairwise(spark, scope):
    rows = many(5)
    cells = [(u, k, s, i, c) for i, (u, s, k, c) in enumerate(rows)]
    if scope == "latest_per_type":
        newest = {}
        for cell in sorted(cells, key=lambda x: (x[2], x[3])):
            newest[cell[0], cell[1]] = cell
        cells = list(newest.values())
    pairs = [(a, b) for a, b in itertools.combinations(cells, 2) if a[0] == b[0] and a[4] == b[4]]
    got = counts.detect_duplicates(make(spark, rows), scope).first()
    assert (int(got.duplicates), int(got.duplicate_bytes)) == (len(pairs), sum(len(a[4]) for a, _ in pairs))


def test_duplicates_of_nothing_and_of_a_huge_group(spark):
    none = counts.detect_duplicates(make(spark, [("http://a.com/", 1, "t", b"x")])).first()
    assert (int(none.duplicates), int(none.duplicate_bytes)) == (0, 0)
    copies = F.lit(33_000_000_000).cast("decimal(19,0)")
    assert spark.range(1).select((copies * (copies - 1) / 2).cast("decimal(38,0)").alias("p")).first().p == 33_000_000_000 * 32_999_999_999 // 2


def test_counts(spark):
    captures = make(spark, [("http://a.com/x.html", 1, None, b""), ("http://a.com/x.html", 2, "t", b""),
                            ("http://a.com/y/", 3, "t", b""), ("dns:a.com", 4, "text/dns", b"")])
    assert [tuple(r) for r in counts.count_content_types(captures).collect()] == [(None, 1), ("t", 2), ("text/dns", 1)]
    assert [tuple(r) for r in counts.count_file_types(captures).collect()] == [("html", 1), ("unknown", 1)]
    assert [tuple(r) for r in counts.count_domains(captures).collect()] == [("com.a", 2)]
    assert counts.count_rows(captures).first().n == 2
    assert [tuple(r) for r in counts.count_urls(captures).collect()][-1] == ("http://a.com/y/", 1)
    short = captures.withColumn("capture_date", F.when(F.col("source_offset") > 1, F.col("capture_date")).otherwise("2004"))
    assert tuple(counts.crawl_date_totals(short).first()) == (4, 2)
    assert [tuple(r) for r in counts.count_crawl_dates(short).collect()] == [("20040124", 2)]
    assert counts.host_directory(captures, "http://s/", "n").first().link == "http://s/n?query=http://a.com/"
    assert [tuple(r) for r in ingest.key_histogram(captures.unionByName(make(spark, [("http://x", 1, "t", b"")]))).orderBy("first_char").collect()] == [
        ("", 1), ("c", 3)]


def test_search(spark):
    captures = make(spark, [("http://a.com/x", 1, "text/html", b"abc"), ("http://a.com/x#f", 2, "text/html; charset=x", b""),
                            ("http://a.com/x", 3, None, b"")])
    assert [(r.content_length, r.url_key) for r in search.find_url(captures, "http://a.com/x").orderBy("capture_date").collect()] == [
        (3, "com.a/x"), (0, "com.a/x")]
    assert search.html_only(captures).count() == 1 and search.html_only(captures, "contains").count() == 2
    assert search.list_arc(captures).first().url_type == "http://a.com/x text/html"
    assert search.list_warc(captures).count() == 3


def test_catalog(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS crawls")
    for name in ("one", "two"):
        make(spark, [("http://a.com/x", 1, "t", b""), ("http://a.com/y", 5, "t", b"")]).write.mode("overwrite").saveAsTable(f"crawls.{name}")
    spark.range(3).write.mode("overwrite").saveAsTable("crawls.other")
    got = [(r.archive, r.captures, r.urls, seconds(r.first_ts), seconds(r.last_ts)) for r in search.archive_catalog(spark, "crawls").collect()]
    assert got == [("one", 2, 2, 1, 5), ("two", 2, 2, 1, 5)]
    spark.sql("DROP DATABASE crawls CASCADE")


def test_load_modes_order_and_identity(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = many(6)
    ingest.ingest(make(spark, rows), table, "create")
    once = ingest.read_table(spark, table).count()
    assert once == len({(u, s, k or "text/plain") for u, s, k, _ in rows})
    ingest.ingest(make(spark, rows[:50]), table, "append")
    assert ingest.read_table(spark, table).count() == once
    ingest.ingest(make(spark, rows[:50] + [("http://new.com/", 7, "t", b"")]), table, "append")
    assert ingest.read_table(spark, table).count() == once + 1
    ingest.ingest(make(spark, rows), str(tmp_path / "other"), "append")
    assert ingest.read_table(spark, str(tmp_path / "other")).count() == once
    ingest.bulk_load(make(spark, rows), table, partitions=3)
    assert spark.read.parquet(table).count() == once
    ranges = sorted(tuple(r) for r in spark.read.parquet(table).groupBy(F.input_file_name()).agg(
        F.min(F.struct("url_key", "capture_ts")), F.max(F.struct("url_key", "capture_ts"))).drop("input_file_name()").collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) == 3


def test_a_load_leaves_replaced_captures_where_they_are(spark, tmp_path):
    rows = [(f"http://a.com/{i % 300}", 1, None if i % 2 else "t", b"%d" % i) for i in range(3000)]
    captures = ingest.loadable(make(spark, rows))
    want = {(r.url_key, r.content_type, r.capture_ts, r.content) for r in ingest.one_per_identity(captures).collect()}
    assert len(want) == 300
    left = ingest.without_replaced(captures)
    assert 300 <= left.count() < 600
    assert want <= {(r.url_key, r.content_type, r.capture_ts, r.content) for r in left.collect()}
    ingest.bulk_load(make(spark, rows), str(tmp_path / "t"))
    assert {(r.url_key, r.content_type, r.capture_ts, r.content) for r in ingest.read_table(spark, str(tmp_path / "t")).collect()} == want
    file = next((tmp_path / "t").glob("load=*/*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
    # Where little is replaced, all of it goes on.
    few = captures.filter("source_offset < 320")
    assert ingest.without_replaced(few).count() == 320


def test_a_load_with_too_many_captures_for_its_plane_is_whole(spark, monkeypatch):
    monkeypatch.setattr(ingest, "MAX_PLANE_BYTES", 64)
    monkeypatch.setattr(ingest, "FREQUENT", 5)
    captures = ingest.loadable(make(spark, [(f"http://a.com/{i % 300}", 1, "t", b"%d" % i) for i in range(3000)]))
    assert sorted(r.source_offset for r in ingest.without_replaced(captures).collect()) == list(range(2700, 3000))


def test_loads_made_at_once_keep_apart(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    real = ingest._names
    monkeypatch.setattr(ingest, "_names", lambda spark, path: [])
    for content in (b"one", b"two", b"three"):
        ingest.append_load(make(spark, [("http://a.com/", 1, "t", content), (f"http://{content.decode()}.com/", 1, "t", content)]), table)
    monkeypatch.setattr(ingest, "_names", real)
    loads = ingest.loads_of(spark, table)
    assert len(loads) == 3 and {n[:10] for n in loads} == {"n000000001"}
    rows = {r.url_key: bytes(r.content) for r in ingest.read_table(spark, table).collect()}
    last = spark.read.parquet(f"{table}/load={loads[-1]}").filter("url_key = 'com.a/'").first()
    assert rows["com.a/"] == bytes(last.content) and len(rows) == 4


def test_a_replaced_table_is_never_seen_half(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    ingest.ingest(make(spark, [("http://old.com/", 1, "t", b"old")]), table, "create")
    ingest.append_load(make(spark, [("http://old.com/2", 1, "t", b"old")]), table)
    seen = []
    real = ingest._put

    def watched(spark, path, text=""):
        keys = lambda: sorted(r.url_key for r in ingest.read_table(spark, table).collect())
        if ingest.FIRST in path:
            seen.append(len(ingest._names(spark, table)))
        real(spark, path, text)
        if ingest.FIRST in path:
            seen.append(keys())

    monkeypatch.setattr(ingest, "_put", watched)
    ingest.bulk_load(make(spark, [("http://new.com/", 1, "t", b"new")]), table)
    # Once the mark is there, the old loads do not count, though they are still there.
    assert seen[1] == ["com.new/"] and [r.url_key for r in ingest.read_table(spark, table).collect()] == ["com.new/"]
    assert len(ingest.loads_of(spark, table)) == 1


def test_loads_apart_are_read_without_an_exchange(spark, tmp_path):
    table = str(tmp_path / "t")
    days = [[(f"http://a{i}.com/", 86400 * day + i, "t", str(day).encode()) for i in range(20)] for day in range(3)]
    for day in days:
        ingest.append_load(make(spark, day), table)
    read = ingest.read_table(spark, table)
    assert read.count() == 60
    read.collect()
    assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()
    # A load over the last day's times: that day and it are compared, the other days are not.
    again = [(u, s, k, b"again") for u, s, k, _ in days[2][5:9]]
    ingest.append_load(make(spark, [*again, ("http://a3.com/", 86400 * 2 + 7, "t", b"new")]), table)
    rows = Counter(bytes(r.content) for r in ingest.read_table(spark, table).collect())
    assert rows == {b"0": 20, b"1": 20, b"2": 16, b"again": 4, b"new": 1}
    # Without its bounds a load counts as one that may meet all others.
    for name in ingest._names(spark, table):
        if name.startswith(ingest.BOUNDS):
            (tmp_path / "t" / name).unlink()
    assert Counter(bytes(r.content) for r in ingest.read_table(spark, table).collect()) == rows


def test_captures_are_shuffled_once_when_they_are_loaded(spark, monkeypatch):
    monkeypatch.setattr(ingest, "FREQUENT", 50)
    rows = [(f"http://a{i % 30}.com/", i % 7, ["t", None][i % 2], str(i).encode()) for i in range(900)] + [("http://hot.com/", 1, "t", str(i).encode()) for i in range(700)]
    captures = cut(make(spark, rows))
    for some in (captures, captures.filter("url_key <> 'com.hot/'")):
        kept = ingest.one_per_identity(some)
        want = {tuple(r) for r in versions.latest_write(some).select("url_key", "capture_ts", "content_type", "source_offset", "content").collect()}
        assert {tuple(r) for r in kept.select("url_key", "capture_ts", "content_type", "source_offset", "content").collect()} == want
        plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    # What is frequent is thinned out before the shuffle.
    assert ingest.last_of_frequent(captures).filter("url_key = 'com.hot/'").count() == 1


def test_append_counts_last_write_and_compacts(spark, tmp_path):
    table = str(tmp_path / "t")
    ingest.ingest(make(spark, [("http://a.com/", 1, "t", b"first"), ("http://b.com/", 1, "t", b"b")]), table, "create")
    for _ in range(2):
        ingest.ingest(make(spark, [("http://a.com/", 1, "t", b"second")]), table, "append")
        assert sorted(bytes(r.content) for r in ingest.read_table(spark, table).collect()) == [b"b", b"second"]
    ingest.append_load(make(spark, [("http://c.com/", 1, "t", b"c")]), table, tag="s-1")
    ingest.append_load(make(spark, [("http://c.com/", 1, "t", b"d")]), table, tag="s-1")
    assert len(ingest.loads_of(spark, table)) == 4
    ingest.compact(spark, table)
    assert len(ingest.loads_of(spark, table)) == 1
    assert sorted(bytes(r.content) for r in ingest.read_table(spark, table).collect()) == [b"b", b"d", b"second"]


def test_as_of_is_linear_in_the_hours_of_a_url(spark):
    times = spark.range(100_000).select(
        F.lit("com.a/").alias("url_key"), F.timestamp_seconds(F.lit(1_000_000_000) + F.col("id") * 3600).alias("capture_ts"))
    requests = times.select("url_key", (F.col("capture_ts") + F.expr("interval 1 second")).alias("request_ts"))
    start = time.time()
    served = versions.as_of(requests, times).agg(F.sum(F.unix_seconds("served_ts") - F.unix_seconds("request_ts"))).first()[0]
    assert served == 99_999 * 3599 - 1
    assert time.time() - start < 30


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session(spark, zone):
    from crawlstrata.functions.dates import capture_ts, date14

    rows = spark.createDataFrame([("20040124034300",), ("2004-01-24T03:43:00Z",), ("2004-01-24 03:43:00",), ("2004-01-24T05:43:00+02:00",)], "d string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = rows.select(F.unix_seconds(capture_ts("d")).alias("s"), date14(capture_ts("d")).alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert {(r.s, r.t) for r in got} == {(1074915780, "20040124034300")}


def test_ids_meet_only_ranges_like_their_block(spark):
    ranges = [(k, f"p{k}", 10 * k, 10 * k + 8) for k in range(1000)] + [(5000, "all", 0, 9999), (5001, "one", 77, 77), (5002, "none", None, None)]
    table = spark.createDataFrame(ranges, "id long, prefix string, start_id long, end_id long")
    ids = spark.range(10_000)
    found = graph.sites_of_ids(ids, "id", table.withColumnRenamed("id", "id"), "site")
    want = sorted((i, k) for k, _, a, b in ranges if a is not None for i in range(a, b + 1))
    assert sorted((r.id, r.site) for r in found.collect()) == want
    joined = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in joined and "CartesianProduct" not in joined
    blocks = table.filter("start_id is not null").withColumn("l", graph._level("start_id", "end_id"))
    pairs = blocks.select("l", F.explode(F.array_distinct(F.array(F.expr("shiftright(start_id, l)"), F.expr("shiftright(end_id, l)")))).alias("b"))
    levels = [r.l for r in blocks.select("l").distinct().collect()]
    asked = ids.withColumn("l", F.explode(F.array([F.lit(x) for x in levels]))).withColumn("b", F.expr("shiftright(id, l)"))
    assert asked.join(pairs, ["l", "b"]).count() < 4 * len(want)


@pytest.mark.parametrize("junk", ["<a ", "</a", "<!--", "<script ", "<a href=", "<a b=\"", "<a x='>", "<a \"", "<b c=\"<a>", "<a href=x>", "<a =", "<p>"])
def test_plain_links_take_time_by_length(spark, junk):
    page = spark.createDataFrame([(junk * ((1 << 20) // len(junk)), "http://a.com/")], "html string, url string")
    start = time.time()
    page.select(F.size(graph.plain_links(F.col("html"), F.col("url")))).collect()
    assert time.time() - start < 10


def test_size_cap_is_inclusive(spark):
    captures = make(spark, [("http://a.com/1", 1, "t", b"x" * 10), ("http://a.com/2", 1, "t", b"x" * 11)])
    assert ingest.loadable(captures, 10).count() == 1


def test_running_totals_and_split_points(spark):
    keys = [f"k{i:03d}" for i in range(200)]
    weights = {k: 1 + i % 7 for i, k in enumerate(keys)}
    weights["k050"] = 700
    rows = spark.createDataFrame(list(weights.items()), "key string, w long").repartition(5)
    got = {r.key: r.before for r in numbering.running_totals(rows, "key", "w").collect()}
    assert got == dict(zip(keys, itertools.accumulate([0] + [weights[k] for k in keys])))
    captures = rows.select(F.explode(F.sequence(F.lit(1), F.col("w"))), F.col("key").alias("url_key"))
    total, want = sum(weights.values()), {}
    for k in keys:
        want.setdefault(got[k] * 5 // total, k)
    want.pop(0)
    assert {r.part: r.boundary for r in ingest.split_points(captures, 5).collect()} == want


WORDS = ["cat", "catch", "cut", "doga", "dogb", "dogs"]


def test_url_ids(spark):
    words = spark.createDataFrame([(w,) for w in reversed(WORDS)], "url string")
    ids = urlids.build_url_ids(words)
    assert [(r.url, r.id) for r in ids.orderBy("id").collect()] == list(zip(WORDS, range(1, 7)))
    assert [r.url for r in urlids.prefix_search(ids, "dog").collect()] == ["doga", "dogb", "dogs"]
    assert [r.url for r in urlids.prefix_search(ids, "cat").collect()] == ["cat", "catch"]
    prefixes = spark.createDataFrame([(1, "dog"), (2, "cat"), (3, "x"), (4, "catch")], "id long, prefix string")
    assert {(r.id, r.start_id, r.end_id) for r in urlids.prefix_id_ranges(prefixes, ids).collect()} == {
        (1, 4, 6), (2, 1, 2), (3, None, None), (4, 2, 2)}
    asked = spark.createDataFrame([("cut",), ("nope",)], "url string")
    assert {tuple(r) for r in urlids.lookup_ids(asked, ids).collect()} == {("cut", 3), ("nope", -1)}
    assert {tuple(r) for r in urlids.lookup_urls(ids.select("id"), ids).collect()} == set(zip(range(1, 7), WORDS))


def test_repeated_urls_use_up_ids(spark):
    words = spark.createDataFrame([(w,) for w in ["b", "a", "b", "c", "é", "z"]], "url string")
    assert {(r.url, r.id) for r in urlids.build_url_ids(words).collect()} == {("a", 1), ("b", 2), ("c", 4), ("z", 5), ("é", 6)}
    assert {(r.url, r.id) for r in urlids.build_url_ids(words, dense=True).collect()} == {("a", 1), ("b", 2), ("c", 3), ("z", 4), ("é", 5)}


def page(*links):
    return "".join(f'<a href="{h}">{t}</a>' for h, t in links).encode()


def test_page_graph(spark):
    captures = make(spark, [
        ("http://a.com/1", 1, "text/html", page(("/2", "x"), ("/2", "y"), ("/9", "z"), ("http://b.com/", "b"))),
        ("http://a.com/1", 2, "text/html", page(("/1", "self"))),
        ("http://a.com/2", 3, "text/html", b"no links"),
        ("http://a.com/8", 4, "text/html", page(("/2", "x"))),
        ("http://b.com/", 5, "text/plain", page(("/2", "x"))),
        ("http://b.com/", 6, None, page(("/2", "x"))),
    ])
    ids = urlids.build_url_ids(spark.createDataFrame([("http://a.com/1",), ("http://a.com/2",), ("http://b.com/",)], "url string"))
    pages = graph.page_graph(graph.page_links(captures), ids)
    assert {(r.source_offset, r.src): r.dst for r in pages.collect()} == {(0, 1): [2, 3], (1, 1): [1], (2, 2): []}
    assert tuple(graph.link_stats(captures, pages).first()) == (6, 4)
    assert {r.src: r.dst for r in graph.latest_adjacency(pages).collect()} == {1: [1], 2: []}


def test_charset_of_links(spark):
    captures = make(spark, [("http://a.com/", 1, "text/html", page(("/é", "x")))])
    assert graph.extract_links(captures).first().target == "http://a.com/Ã©"
    assert graph.extract_links(captures, "UTF-8").first().target == "http://a.com/é"


HREFS = ["/x", "y", "../z", "./w", "?q=1", "#f", "", "//b.com/p", "http://c.com/a/../b", "mailto:a@b", "javascript:f()",
         "/a?x=/../y", "d/./e/../g", "../../..", "../../../x", "//b.com/p/../q", "HTTP://c.com/./d#./e", "..", ".", "/..", "/x&amp;y", " /sp "]


def test_plain_links_agree_with_parser(spark):
    bases = ["http://a.com", "http://a.com/", "http://a.com/d/e/f.html?u=/v#w"]
    captures = make(spark, [(b, i, "text/html", b"<!-- <a href=/c> --><script>'<a href=/s>'</script>" + page((h, "t")))
                            for b in bases for i, h in enumerate(HREFS)])
    full = {(r.source_offset, r.target) for r in graph.extract_links(captures, "UTF-8").collect()}
    plain = {(r.source_offset, r.target) for r in graph.extract_links(captures, "UTF-8", "plain").collect()}
    assert full == plain and len(full) == len(bases) * (len(HREFS) - 1)


ODD_MARKUP = [
    '<a title="a<b" href="/x">t</a>', "<a title='a>b' href='/x'>t<b>u</b></a>v", "<a href=/x title=\"<a href='/no'>\">one", "<A HREF = '/x' >A<br>b &amp;amp; c</A>",
    '<img alt="<a href=/no>"><a href="/x">y</a>', "<a data-href=/no>n</a><a href>empty</a>", "<a name=n>t</a><a\nhref='/x'\n>a\n\tb</a>", "<a href='/x'>one<a href=\"/y\">two</a>",
    "<a href='/x'><p>a</p><p>b</p></a>", "<a hrefs=1 href=2 href=3>t</a>", "<a/href=/x>t</a>", "<abbr href=/no>t</abbr>", "<a href=/x>a&lt;b&gt;&nbsp;&quot;c&#39;", "<a href='/x' <b>t</b>",
    'x <a href="/y"> z <a x="> <a href=/p>in</a> <a href=\'/q\'>rest', "<a href=/x", "<a", "<", "", "<!DOCTYPE a><a href=/x>t</a>", "<a href=/x>unclosed <i>t", "<a =\"/no\" href=/x>t</a>",
    "<a title=x'y href=/x>t</a>", "<a href=\"/x\"title='t'>t</a>", "</a><a href='/x'>t</div>u</a>", "<a onclick=\"if (a<b) go('c>d')\" href=/x>s</a>", "<ul><li><a href=/x>a</a></li></ul>",
]


def test_plain_links_and_their_texts_agree_with_the_parser_on_odd_markup(spark):
    rnd = random.Random(8)
    # A tag that the end of the page cuts off is text to the parser and nothing here.
    whole = [m for m in ODD_MARKUP if m.rfind("<") <= m.rfind(">")]
    pages = [*ODD_MARKUP, *("".join(rnd.choice(whole) for _ in range(3)) for _ in range(300))]
    rows = spark.createDataFrame([(i, p, "http://a.com/d/") for i, p in enumerate(pages)], "i long, html string, url string")
    both = rows.select("i", "html", graph.plain_links("html", F.col("url")).alias("plain"), graph.parsed_links("html", "url").alias("parsed")).collect()
    for r in both:
        assert [(x.target, x.anchor) for x in r.plain] == [(x.target, x.anchor) for x in r.parsed], r.html


def test_site_graph_matches_brute_force(spark):
    rnd = random.Random(8)
    prefixes = [(1, "a/", 1, 200_000), (2, "a/b/", 1000, 90_000), (3, "c/", 250_000, 300_000), (4, "none/", None, None)]
    adjacency = {s: sorted({rnd.choice([5, rnd.randrange(1, 320_000)]) for _ in range(6)}) for s in rnd.sample(range(1, 310_000), 80)}
    want = {}
    for s, targets in adjacency.items():
        for t in targets:
            inside = [(len(p), -i, i) for i, p, a, b in prefixes if a and a <= t <= b]
            for i, _, a, b in prefixes:
                if inside and a and a <= s <= b:
                    key = (i, max(inside)[2])
                    want[key] = want.get(key, 0) + 1
    got = graph.site_graph(spark.createDataFrame(list(adjacency.items()), "src long, dst array<long>"),
                           spark.createDataFrame(prefixes, "id long, prefix string, start_id long, end_id long"))
    assert {(r.source, r.target): r.weight for r in got.collect()} == want
    disjoint = [p for p in prefixes if p[0] != 2]
    weights = graph.site_graph(spark.createDataFrame(list(adjacency.items()), "src long, dst array<long>"),
                               spark.createDataFrame(disjoint, "id long, prefix string, start_id long, end_id long"))
    covered = lambda i: any(a and a <= i <= b for _, _, a, b in disjoint)
    assert weights.agg(F.sum("weight")).first()[0] == sum(covered(s) and covered(t) for s, ts in adjacency.items() for t in ts)


def test_seed_rule(spark):
    hosts = spark.createDataFrame([(h,) for h in ["seed.com", "x.seed.com", "x.seed.com.evil", "x.seed.comx", "notseed.com", "com", None]], "host string")
    seeds = spark.createDataFrame([("seed.com",), ("other.org",)], "host string")
    assert {r.host for r in outlinks.seed_hosts(hosts, seeds).collect()} == {"seed.com", "x.seed.com", "x.seed.com.evil", "x.seed.comx"}


META = "code string, url string, approved string, line_no long"


def test_codes(spark):
    meta = spark.createDataFrame([("A", "http://www.b.com/", "", 1), ("B", "http://a.b.com/", "", 2), ("C", "http://b.com/x", "", 3)], META)
    hosts = spark.createDataFrame([("x.a.b.com",), ("b.com",), ("c.com",)], "host string")
    assert {tuple(r) for r in outlinks.host_codes(hosts, meta).collect()} == {("x.a.b.com", "B"), ("b.com", "C")}
    labels = spark.createDataFrame([("b",), ("zz",)], "label string")
    assert {tuple(r) for r in outlinks.code_by_label(labels, meta).collect()} == {("b", "C"), ("zz", None)}


def test_outlinks(spark):
    seeds = spark.createDataFrame([("b.com",), ("src.com",)], "host string")
    meta = spark.createDataFrame([("U1", "http://www.b.com/", "", 1), ("U9", "http://c.com/", "", 2)], META)
    captures = make(spark, [
        ("http://www.src.com/p", 1, "text/html", page(("http://x.b.com/", "old"), ("http://c.com/", "C 1!"), ("mailto:m@c.com", "m"), ("/rel", "r"), ("http://d.com/", ""))),
        ("http://www.src.com/p", 2, "text/html; charset=utf-8", page(("http://x.b.com/", " new\n text "))),
        ("http://e.com/", 3, "application/xhtml+xml html", b"none"),
        ("http://e.com/t", 3, "text/plain", page(("http://x.b.com/", "old"))),
        ("dns:e.com", 3, "text/html", page(("http://x.b.com/", "old"))),
    ]).withColumn("http_headers", F.create_map(F.lit("content-type"), F.lit("text/html")))
    got = {(r.row_key, r.href): (r.anchor, r.code, r.in_seeds) for r in outlinks.extract_outlinks(captures, seeds, meta).collect()}
    key = "com.src.www/p|20040124"
    assert got == {(key, "http://x.b.com/"): ("new text", "U1", True), (key, "http://c.com/"): ("C ", None, False)}
    relative = outlinks.extract_outlinks(captures, seeds, meta, absolute_only=False)
    assert {r.href for r in relative.collect()} == {"http://x.b.com/", "http://c.com/", "http://www.src.com/rel"}
    pages = {r.row_key: (r.code, r.in_seeds) for r in outlinks.outlink_pages(captures, seeds, meta).collect()}
    assert pages == {key: (None, True), "com.e/|20040124": (None, False)}


def test_site_of_key_and_base_paths(spark):
    captures = make(spark, [("http://www.house.gov/a/1", 1, "t", b""), ("http://www.house.gov/a/2", 1, "t", b""), ("http://www.house.gov/b", 1, "t", b""),
                            ("http://house.senate.gov/", 1, "t", b""), ("http://x.org/", 1, "t", b""),
                            ("http://longlonglonglonglonglonglonglong.org/house", 1, "t", b"")])
    ids = spark.createDataFrame([("house",), ("senate",), ("",)], "site_id string")
    assert {r.url_key for r in text.site_of_key(captures, ids, 40).collect()} == {"gov.house.www/a/1", "gov.house.www/a/2", "gov.house.www/b"}
    assert "org.longlonglonglonglonglonglonglong/house" in {r.url_key for r in text.site_of_key(captures, ids).collect()}
    assert [tuple(r) for r in text.site_base_paths(captures, ids, 40).collect()] == [("house", "gov.house.www/a", 2), ("house", "gov.house.www/b", 1)]


def test_text_and_replay(spark, tmp_path):
    captures = make(spark, [("http://www.house.gov/a", 1, "text/html", b"<p>Hi</p><p>you</p><a href='/b'>"), ("http://www.house.gov/b", 1, "text/plain", b"<a href='/b'>")])
    ids = spark.createDataFrame([("house",)], "site_id string")
    texts = text.extract_text(captures, ids)
    row = texts.first()
    assert (row.site_id, row.text, texts.count()) == ("house", "Hi you", 1)
    assert row.file_name.startswith("20040124034301") and row.file_name.endswith(".txt") and len(row.file_name) == 58
    text.write_text(texts, str(tmp_path / "texts"))
    assert spark.read.parquet(str(tmp_path / "texts")).filter("site_id = 'house'").count() == 1
    copy = text.rewrite_links(captures, "http://s/", "arch").collect()
    assert [r.html for r in copy] == ["<p>Hi</p><p>you</p><a href='http://s/arch/1074915781000/http://www.house.gov/b'>"]


@pytest.mark.parametrize("with_bytes", [False, True])
def test_increment(spark, tmp_path, with_bytes):
    files, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    files.mkdir()

    def put(name, *bodies):
        (files / name).write_bytes(arc_file([arc_record(u, "20040124034300", "text/html", http(b)) for u, b in bodies]))

    def run():
        ingest_increment(spark, str(files), table, checkpoint, with_bytes=with_bytes).awaitTermination()
        loaded = ingest.read_table(spark, table)
        return {(r.url_key, bytes(r.content)) for r in loaded.collect()}, loaded.count()

    put("1.arc.gz", ("http://a.com/1", b"1"), ("http://a.com/2", b"2"))
    assert run() == ({("com.a/1", b"1"), ("com.a/2", b"2")}, 2)
    put("2.arc.gz", ("http://a.com/2", b"again"), ("http://a.com/3", b"3"))
    old = 1_000_000_000
    os.utime(files / "2.arc.gz", (old, old))
    assert run() == ({("com.a/1", b"1"), ("com.a/2", b"again"), ("com.a/3", b"3")}, 3)
    assert run()[1] == 3
    groups = counts.duplicate_groups(spark.read.parquet(table))
    assert "content:binary" not in groups._jdf.queryExecution().executedPlan().toString()
