"""Jobs that must move little: their answers beside brute force, and what their plans move."""

import random
import re

import pytest
from pyspark.sql import functions as F

from crawlstrata.functions.keys import url_key
from crawlstrata.operators import ingest, patterns, planes, search, text, urlids, versions
from crawlstrata.operators.numbering import running_totals
from crawlstrata.plans import catalog, views
from crawlstrata.session import checkpoint_dir


def executed(df):
    """The final plan, after it ran."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(df, name):
    return re.findall(rf"(?:^|[\s+:\-]){name}\b[^\n]*", df._jdf.queryExecution().executedPlan().toString())


def site_rows(seed):
    rnd = random.Random(seed)
    letters = "abé😀/."
    ids = sorted({"".join(rnd.choice(letters) for _ in range(rnd.choice([1, 2, 3, 5, 8, 9, 12, 20]))) for _ in range(60)} | {"abcabcabcabc", "abcabcabcabcabc"})
    keys = ["".join(rnd.choice([*ids[:50], *letters, "x", "yy", "zzzz"]) for _ in range(rnd.randrange(5))) for _ in range(400)]
    return sorted(set(keys) | {"", "abcabcabcabcab", "x" * 50_000 + "abcabcabcabcabc"}), [i for i in ids if len(i) > 2]


@pytest.mark.parametrize("span", [None, 9])
@pytest.mark.parametrize("max_chars", [1 << 20, 0])
def test_sole_string_equals_brute_force(spark, span, max_chars):
    keys, ids = site_rows(5)
    texts = spark.createDataFrame([(k,) for k in [*keys, None]], "k string").repartition(3)
    strings = spark.createDataFrame([(i,) for i in [*ids, *ids, "", None]], "s string")
    found = {r.k: r.s for r in patterns.sole_string(texts, strings, span, max_chars).collect()}
    want = {k: [i for i in ids if i in k[:span]] for k in keys}
    assert found == {k: held[0] for k, held in want.items() if len(held) == 1} and found
    assert patterns.sole_string(texts, strings.filter("false"), span, max_chars).collect() == []


def test_site_of_key_shuffles_keys_only(spark):
    keys = spark.createDataFrame([(f"com.site{i % 50}/page/{i}",) for i in range(3000)], "url_key string")
    ids = spark.createDataFrame([(f"site{i}",) for i in range(50)], "site_id string")
    found = text.site_of_key(keys, ids)
    assert "Join" not in executed(found) and len(nodes(found, "Exchange")) == 1  # distinct keys
    # Above the bound: the places where an id may begin, not every part of every key.
    many = text.site_of_key(keys, ids, max_chars=0)
    assert {tuple(r) for r in many.collect()} == {tuple(r) for r in found.collect()}


def test_rows_of_keys_equal_brute_force_through_a_plane(spark):
    rnd = random.Random(6)
    rows = [(rnd.randrange(40) or None, rnd.choice(["a", "b", None]), "wide" * 50, i) for i in range(5000)]
    keys = [(a, b) for a, b in {(a, b) for a, b, *_ in rows} if rnd.random() < 0.4]
    df = spark.createDataFrame(rows, "a long, b string, content string, i long").repartition(4)
    wanted = spark.createDataFrame(keys, "a long, b string").repartition(3)
    want = sorted(i for a, b, _, i in rows if (a, b) in set(keys))
    for small, most in ((0, 1 << 20), (0, 1), (50_000, 1)):
        assert sorted(r.i for r in planes.rows_of_keys(df, wanted, small, most).collect()) == want
    assert planes.rows_of_keys(df, wanted.filter("false"), 0).collect() == []


def test_planes_let_few_rows_through_in_vain(spark):
    keys = spark.range(20_000).select(F.col("id").alias("k"))
    other = spark.range(1_000_000, 1_400_000).select(F.col("id").alias("k"))
    assert keys.filter(planes.may_hold(keys, ["k"], 20_000)).count() == 20_000
    assert other.filter(planes.may_hold(keys, ["k"], 20_000)).count() < 1200


@pytest.mark.parametrize("small", [0, 50_000])
def test_latest_capture_moves_no_content(spark, tmp_path, monkeypatch, small):
    rows = [(f"com.a/{i % 700}", i % 900, f"f{i % 3}", i, bytearray(str(i).encode() * 20)) for i in range(6000)]
    path = str(tmp_path / "captures")
    schema = "url_key string, ts long, source_file string, source_offset long, content binary"
    spark.createDataFrame(rows, schema).withColumn("capture_ts", F.timestamp_seconds("ts")).drop("ts").repartition(5).write.parquet(path)
    monkeypatch.setattr(versions, "rows_of_keys", lambda rows, keys: planes.rows_of_keys(rows, keys, small=small))
    best = {}
    for key, ts, file, offset, content in rows:
        best[key] = max(best.get(key, (-1, "", 0, b"")), (ts, file, offset, bytes(content)))
    found = versions.latest_capture(spark.read.parquet(path))
    assert {r.url_key: (r.source_file, r.source_offset, bytes(r.content)) for r in found.collect()} == {k: v[1:] for k, v in best.items()}
    assert "Sort" not in executed(found)
    assert all("BroadcastExchange" in n for n in nodes(found, r"\w*Exchange"))


def url_rows(seed):
    rnd = random.Random(seed)
    urls = {"".join(rnd.choice("abcé\U0010ffff") for _ in range(rnd.randrange(0, 7))) for _ in range(600)}
    # Python sorts by code point, as UTF-8 bytes do.
    ids, at = [], 0
    for url in sorted(urls):
        at += rnd.randrange(1, 4)
        ids.append((url, at))
    prefixes = [(i, "".join(rnd.choice("abcdé\U0010ffff") for _ in range(rnd.randrange(0, 6)))) for i in range(300)]
    return ids, [*prefixes, (300, None), (301, "zz"), (302, "zz"), (303, ""), (5, "ab"), (7, prefixes[7][1]), (None, "a")]


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_prefix_ranges_equal_brute_force_over_range_borders(spark, partitions):
    ids, prefixes = url_rows(7)
    url_ids = spark.createDataFrame(ids, "url string, id long").repartition(5)
    wanted = spark.createDataFrame(prefixes, "id long, prefix string")
    under = lambda p: [i for u, i in ids if p is not None and u.startswith(p)]
    want = {}
    for k, p in prefixes:
        if k is not None:
            want.setdefault(k, []).extend(under(p))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = urlids.prefix_id_ranges(wanted, url_ids).collect()
        parts = urlids.prefix_id_ranges(wanted, url_ids, ordered=False).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == len(prefixes)
    for r in found:
        got = want.get(r.id, [])
        assert (r.start_id, r.end_id) == ((min(got), max(got)) if got else (None, None)), r
    order = lambda rows: sorted(map(str, rows))
    assert order(found) == order(parts)


def test_prefix_ranges_make_no_row_per_length(spark):
    ids, prefixes = url_rows(8)
    found = urlids.prefix_id_ranges(spark.createDataFrame(prefixes, "id long, prefix string"), spark.createDataFrame(ids, "url string, id long"))
    assert "Generate" not in executed(found)


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_running_totals_add_one_exchange(spark, n):
    rnd = random.Random(9)
    weights = {f"{rnd.random():.9f}": rnd.randrange(0, 5) for _ in range(n)}
    rows = spark.createDataFrame(list(weights.items()), "key string, w long").repartition(7)
    placed = running_totals(rows, "key", "w")
    before = 0
    for r in sorted(placed.collect(), key=lambda r: r.key):
        assert (r.before, r.total) == (before, sum(weights.values()))
        before += weights[r.key]
    # The rows are written in their ranges; only the ranges' sums are exchanged after that.
    assert executed(placed).count("Exchange hashpartitioning(_range") <= 2 and "SortMergeJoin" not in executed(placed)


def rows_scanned(df):
    """Rows that the scan of the executed plan gave on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plan = leaves.apply(0)
    while "QueryStage" in plan.getClass().getSimpleName() or "Adaptive" in plan.getClass().getSimpleName():
        plan = (plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan.plan()).collectLeaves().apply(0)
    return plan.metrics().get("numOutputRows").get().value()


def test_a_look_up_of_one_url_reads_few_row_groups(spark, tmp_path):
    rnd = random.Random(10)
    # URLs in another order than their keys, so that first and last URL of a row group tell nothing.
    rows = [(f"http://h{rnd.randrange(10**6):06d}.com/{i}", bytearray(rnd.randbytes(300)), i) for i in range(20_000)]
    captures = spark.createDataFrame(rows, "url string, content binary, source_offset long").select(
        "*", url_key("url").alias("url_key"), F.lit("f").alias("source_file"), F.lit("t").alias("content_type"), F.lit("response").alias("record_type"),
        F.lit("20040124").alias("capture_date"), F.timestamp_seconds(F.lit(0)).alias("capture_ts"), F.lit(300).cast("long").alias("content_length"),
    )
    table = str(tmp_path / "t")
    ingest.bulk_load(captures, table, partitions=2, group_bytes=100_000)
    read = ingest.read_table(spark, table)
    assert read.count() == len(rows)
    wanted = rows[777]
    by_url = search.find_url(read, wanted[0])
    by_key = read.filter(F.col("url_key") == url_key(F.lit(wanted[0])))
    assert by_url.count() == 1 and by_key.count() == 1
    assert rows_scanned(by_url) < 2000 and rows_scanned(by_key) < 2000
    assert rows_scanned(search.find_url(read, "http://h0.com/none")) < 1000


# Ids in buckets


@pytest.mark.parametrize("buckets", [2, 4, 7])
def test_saved_ids_stay_where_they_lie(spark, tmp_path, buckets):
    urls = [f"http://{i % 37}.com/{i}" for i in range(500)]
    ids = urlids.build_url_ids(spark.createDataFrame([(u,) for u in urls], "url string"))
    saved = urlids.save_url_ids(ids, f"saved_{buckets}", buckets, path=str(tmp_path / "ids"))
    assert saved.exceptAll(ids).count() == 0 and saved.count() == 500
    asked = [*urls[::3], *["http://1.com/1"] * 2000, "http://none.com/", None]
    used = urlids.ids_in_use(spark.createDataFrame([(u,) for u in asked], "url string").repartition(3), saved, buckets)
    place = {u: i + 1 for i, u in enumerate(sorted(urls, key=str.encode))}
    assert sorted(map(tuple, used.collect())) == sorted((u, place[u]) for u in {*urls[::3], "http://1.com/1"})
    plan = executed(used).split("== Initial Plan ==")[0]
    scan = next(i for i, line in enumerate(plan.splitlines()) if "FileScan parquet" in line or "Scan parquet" in line)
    lines, depth = plan.splitlines(), lambda line: len(line) - len(line.lstrip(" :+-*("))
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above, level = [*above, line], depth(line)
    assert not any("Exchange" in line for line in above) and any("Join" in line for line in above) and "Bucketed: true" in lines[scan]
    spark.sql(f"DROP TABLE saved_{buckets}")


def test_saved_ids_by_id_and_replaced(spark, tmp_path):
    for n in (5, 3):
        ids = urlids.build_url_ids(spark.createDataFrame([(f"http://a.com/{i}",) for i in range(n)], "url string"))
        saved = urlids.save_url_ids(ids, "saved_by_id", 3, by="id", path=str(tmp_path / "ids"))
        assert urlids.lookup_urls(spark.range(10), saved).count() == n
    none = urlids.ids_in_use(spark.createDataFrame([], "url string"), saved, 3)
    assert none.count() == 0 and none.columns == ["url", "id"]
    spark.sql("DROP TABLE saved_by_id")


@pytest.fixture
def tables(spark, tmp_path):
    """A few pages and documents, and many events."""
    html = F.concat(F.lit("<title>t</title><a href='/x"), F.col("page_id").cast("string"), F.lit("'>x</a>"), F.repeat(F.lit(" word"), 300))
    url = F.concat(F.lit("http://a.b.example.com/"), F.col("page_id").cast("string"))
    pages = spark.range(0, 40, 1, 4).select(F.col("id").alias("page_id")).select("page_id", url.alias("url"), html.alias("html"))
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    spark.range(5).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    kind = F.element_at(F.array(*map(F.lit, ["view", "click", "signup", "purchase", "error"])), (F.col("id") % 5 + 1).cast("int"))
    events = spark.range(0, 1000, 1, 1).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60).alias("ts"), kind.alias("event_type"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_captures_of_few_pages_are_spread_over_tasks(spark, tables, monkeypatch):
    monkeypatch.setattr(views, "PART_CAPTURES", 50, raising=False)
    captures = views.captures(spark, tables).filter("content_type = 'text/html'")
    parts = captures.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 600
    # 40 pages in 20 parts: a few of these are empty by chance.
    assert len(parts) > 10 and max(r["count"] for r in parts) < 150
    assert catalog.page_graph(spark, tables).count() == 600


@pytest.mark.parametrize("name", ["warc_in_splits", "webarchive_captures"])
def test_a_large_archive_is_written_by_many_tasks(spark, tables, monkeypatch, name):
    from pathlib import Path

    folders = lambda: set(Path(checkpoint_dir(spark).removeprefix("file:")).glob("stage-*/warc-*"))
    run, before = getattr(catalog, name), folders()
    rows = sorted(map(str, run(spark, tables).collect()))
    (one,) = folders() - before
    assert len(rows) == 80 and len(list(one.glob("*.warc.gz"))) == 1
    monkeypatch.setattr(catalog, "ARCHIVE_BYTES", 1 << 14, raising=False)
    before = folders()
    assert sorted(map(str, run(spark, tables).collect())) == rows
    (many,) = folders() - before
    sizes = [file.stat().st_size for file in many.glob("*.warc.gz")]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
