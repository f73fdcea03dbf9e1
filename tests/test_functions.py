"""Column expressions on hand-written inputs, one case per rule."""

import pytest
from pyspark.sql import functions as F

from crawlstrata.functions import content, dates, keys
from crawlstrata.functions.register import register_functions


def values(spark, expression, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def check(spark, expression, cases):
    assert values(spark, expression, [c[0] for c in cases]) == [c[1] for c in cases]


def test_url_key(spark):
    check(spark, keys.url_key("v"), [
        ("http://www.house.gov/mthompson/the_1st_district.htm", "gov.house.www/mthompson/the_1st_district.htm"),
        ("http://www.house.gov:80/a?b#c", "gov.house.www:80/a?b"),
        ("https://user:pw@a.b.com/x", "com.b.a/x"),
        ("http://a.com?q=/z", "com.a?q=/z"),
        ("http://a.com", "com.a"),
        ("HTTP://WWW.A.com/X", "com.A.WWW/X"),
        ("  http://a.com/ ", "com.a/"),
        ("http://a.com:/x", "com.a/x"),
        ("http://a.com:080/x", "com.a:80/x"),
        ("http://a.com:8x/", None),
        ("dns:www.a.com", None),
        ("filedesc://x.arc", None),
        ("www.a.com/x", None),
        ("", None),
        (None, None),
        ("http://a.com/b/../c/./d", "com.a/c/d"),
        ("http://a.com/b/c/..", "com.a/b/"),
        ("http://a.com/../x", "com.a/../x"),
        ("http://a_b.com/x y|z", "com.a_b/x y|z"),
        ("http://a.com./x", "com.a/x"),
        ("http://x#frag?no", "x"),
        ("mailto:me@a.com", "me@a.com"),
    ])


def test_key_back(spark):
    check(spark, keys.key_to_url("v"), [
        ("gov.house.www/mthompson/the_1st_district.htm", "http://www.house.gov/mthompson/the_1st_district.htm"),
        ("gov.house.www:80/a?b", "http://www.house.gov:80/a?b"),
        ("com.a/", "http://a.com"),
        ("com.a", "http://a.com"),
        ("com.a/b/", "http://a.com/b/"),
    ])
    check(spark, keys.key_to_host("v"), [("com.a.www:81/b", "http://www.a.com:81"), ("x", "http://x")])
    check(spark, keys.key_domain("v"), [("com.a:81/b/c", "com.a:81"), ("com.a", "com.a"), ("/x", "")])


def test_file_type(spark):
    check(spark, keys.file_type("v"), [
        ("com.a/b/c.html", "html"), ("com.a/b/", ""), ("com.a/b/c", ""), ("com.a/x.JPG", "JPG"),
        ("com.a/x.123456789", ""), ("com.a/x.12345678", "12345678"), ("com.a/x.7", ""), ("com.a/x.77", "77"),
        ("com.example.www", "www"), ("com.a/x.html.", "html"), ("com.a/..", ""), ("", ""), (None, None),
    ])


def test_base_path(spark):
    check(spark, keys.base_path("v"), [
        ("com.a/b/c/d", "com.a/b"), ("com.a/b", "com.a/b"), ("com.a/", "com.a"), ("com.a", "com.a"),
        ("com.a//b", "com.a/"),
    ])


def test_host_name(spark):
    cases = [
        ("http://www.a.com/x", "a.com"), ("http://a.com:80/x", "a.com"), ("http://u@b.a.com", "b.a.com"),
        ("http://1.2.3.4/x", None), ("http://a_b.com/", None), ("http://a b.com/", None), ("not a url", None),
        ("mailto:x@y.com", None), (" http://A.com ", "A.com"), ("/rel", None), (None, None),
    ]
    check(spark, keys.host_name("v"), cases)
    register_functions(spark)
    check(spark, F.expr("host_name(v)"), cases)


def test_site_label(spark):
    check(spark, keys.site_label("v"), [
        ("http://www.Example.org/x", "example"), ("http://localhost/x", "http://localhost/x"),
        ("nonsense", "nonsense"), ("http://a.b.co.uk", "co"),
    ])


def test_dates(spark):
    check(spark, dates.capture_ts("v").cast("string"), [
        ("20040124034300", "2004-01-24 03:43:00"), ("20040124123000", "2004-01-24 12:30:00"),
        ("2013-02-27T15:01:31Z", "2013-02-27 15:01:31"), ("2004", None), ("20041324034300", None), (None, None),
    ])
    check(spark, dates.capture_day("v"), [("20040124034300", "20040124"), ("2004012", None), (None, None)])
    for unit, expected in [("year", "2004"), ("month", "01"), ("day", "24"), ("week", "20040124034300")]:
        check(spark, dates.date_unit("v", unit), [("20040124034300", expected), ("2004", None), (None, None)])
    register_functions(spark)
    check(spark, F.expr("date_unit(v, 'month')"), [("20040124034300", "01"), ("2004", None), (None, None)])


def test_text(spark):
    check(spark, content.clean_anchor("v"), [
        ("  Hello,\n  it's   2 o'clock! ", "Hello, it's  o'clock"), ("été", "t"),
    ])
    check(spark, content.strip_tags("v"), [("<p>a<b>c</b></p>", "ac"), ("<a\nb>x", "<a\nb>x"), ("a < b > c", "a  c")])
    check(spark, content.charset_of("v"), [
        ("text/html; charset=UTF-8", "utf-8"), ('text/html;charset="Windows-1252"', "windows-1252"),
        ("text/html", None), (None, None),
    ])


def test_parse_http(spark):
    rows = [
        ("http://a/", b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=windows-1252\r\nSet-Cookie: a\r\n"
                      b"set-cookie: b\r\nX: 1\r\n 2\r\n\r\n\x80\r\n\r\nz"),
        ("http://b/", b"no header\r\n\r\nbody"),
        ("http://c/", b"HTTP/1.0 404 Not Found\r\n\r\n"),
        ("ftp://d/", b"HTTP/1.1 200 OK\r\n\r\nx"),
        ("http://e/", None),
    ]
    df = spark.createDataFrame(rows, "url string, payload binary").withColumn("content_type", F.lit("text/html"))
    got = {r.url: r for r in content.html_text_decode(content.parse_http(df)).collect()}
    assert got["http://a/"].http_status == 200
    assert got["http://a/"].http_headers == {
        "content-type": "text/html; charset=windows-1252", "set-cookie": "a, b", "x": "1 2"}
    assert bytes(got["http://a/"].content) == b"\x80\r\n\r\nz"
    assert got["http://a/"].text == "€\r\n\r\nz"
    assert got["http://b/"].http_status == -1 and bytes(got["http://b/"].content) == b"no header\r\n\r\nbody"
    assert got["http://c/"].http_status == 404 and bytes(got["http://c/"].content) == b""
    assert got["ftp://d/"].http_status == -1
    assert got["http://e/"].http_status == -1 and got["http://e/"].content is None


@pytest.mark.parametrize("charset,body,expected", [
    ("utf-8", "é".encode(), "é"), ("utf-8", b"a\xffb", "a�b"), ("iso-8859-1", b"\xe9", "é"),
    ("shift_jis", "日".encode("shift_jis"), "日"), ("no-such", b"\xe9", "é"), (None, b"\xe9", "é"),
])
def test_decode_text(spark, charset, body, expected):
    df = spark.createDataFrame([(body, charset)], "b binary, c string")
    assert df.select(content.decode_text("b", "c")).collect()[0][0] == expected
