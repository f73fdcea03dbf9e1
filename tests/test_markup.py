"""Single pages, with the standard library's HTML parser as a second opinion on links and text."""

import random
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

import duckdb
import pytest

from crawlstrata.operators import markup
from crawlstrata.operators.markup import absolute, links_of, replay_copy, text_of

PAGE = "http://www.a.com/dir/page.html?q=1"


@pytest.mark.parametrize("html,expected", [
    ('<a href="/x">t</a>', [("http://www.a.com/x", "t")]),
    ("<A HREF = 'y.html' >t <b>u</b>\n v</A>", [("http://www.a.com/dir/y.html", "t u v")]),
    ("<a class=c href=../z>t</a>", [("http://www.a.com/z", "t")]),
    ('<a title="href=no > x" href="?p=2&amp;r">t</a>', [("http://www.a.com/dir/page.html?p=2&r", "t")]),
    ('<a href="#top">t</a>', [(PAGE + "#top", "t")]),
    ('<a href="">t</a><a href>u</a>', [(PAGE, "t"), (PAGE, "u")]),
    ('<a name=x>no</a>', []),
    ('<a href="mailto:a@b.c">m</a><a href="javascript:f()">j</a>', [("mailto:a@b.c", "m"), ("", "j")]),
    ('<a href="//b.com/x">t</a><a href="HTTPS://C.com/">u</a>', [("http://b.com/x", "t"), ("https://C.com/", "u")]),
    ('<base href="http://b.org/d/"><a href="e">t</a>', [("http://b.org/d/e", "t")]),
    ('<!-- <a href="/no">n</a> --><script>x="<a href=/no>"</script><a href="/y">t</a>', [("http://www.a.com/y", "t")]),
    ('<a href="/1">one<a href="/2">two', [("http://www.a.com/1", "one"), ("http://www.a.com/2", "two")]),
    ('<p title=it\'s><a href="/x">t</a>', [("http://www.a.com/x", "t")]),
    ('a < b <a href="/x">1<p>2</p>3</a>', [("http://www.a.com/x", "1 2 3")]),
    ('<title><a href="/no">n</a></title>', []),
    ("<a href='/x'", []),
    ("", []),
])
def test_links(html, expected):
    assert links_of(html, PAGE) == expected


def test_links_absolute_only():
    assert links_of('<a href="/x">t</a><a href="http://b.com/">u</a>', "") == [("", "t"), ("http://b.com/", "u")]


@pytest.mark.parametrize("html,expected", [
    ("<p>a</p><p>b</p>", "a b"), ("<b>a</b><i>b</i>", "ab"), ("a<br>b<br/>c", "a b c"), ("<div>One</div>Two", "One Two"),
    ("<script>no</script>x<style>no</style>", "x"), ("<title>T</title>x &amp; y&nbsp;z", "T x & y z"),
    (" a\r\n\t b ", "a b"), ("<!-- no -->x<!doctype html>", "x"), ("a <> b", "a <> b"), ("", ""),
])
def test_text(html, expected):
    assert text_of(html) == expected


@pytest.mark.parametrize("html,expected", [
    ('<a href="/x">', '<a href="P/http://www.a.com/x">'),
    ("<img alt='/y' src=i.png>", "<img alt='/y' src=P/http://www.a.com/dir/i.png>"),
    ('<a href="mailto:x@y"><a href="javascript:f()">', '<a href="mailto:x@y"><a href="javascript:f()">'),
    ('<div background="b.gif" data="/n">', '<div background="P/http://www.a.com/dir/b.gif" data="/n">'),
    ('<base href="http://b.org/"><LINK HREF="s.css">', '<base href="http://b.org/"><LINK HREF="P/http://b.org/s.css">'),
    ("<style>@import 'a.css'; p{background:url( \"b.png\" )}</style>",
     "<style>@import 'P/http://www.a.com/dir/a.css'; p{background:url( \"P/http://www.a.com/dir/b.png\" )}</style>"),
    ('<p title="<a href=/x>">', '<p title="<a href=/x>">'),
    ("<a href=''>", "<a href=''>"),
])
def test_replay(html, expected):
    assert replay_copy(html, PAGE, "P/") == expected


def test_absolute():
    assert absolute("http://a.com/b/c", "/d/../e") == "http://a.com/e"
    assert absolute("http://a.com", "x") == "http://a.com/x"
    assert absolute("http://a.com/b", "http://C.com/x/../y?z=/../q") == "http://C.com/y?z=/../q"
    assert absolute("http://a.com/b", "../../x") == "http://a.com/../../x"
    assert absolute("http://a.com/b/", "//c.com/./d") == "http://c.com/d"
    assert absolute("ftp://a.com/b", "c") == "ftp://a.com/c"
    assert absolute("", "x") == ""


class SecondOpinion(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links, self.text, self.raw = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.raw += tag in ("script", "style")
        if tag == "a" and "href" in dict(attrs):
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        self.raw -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.raw:
            self.text.append(data)


def test_given_pages_agree_with_standard_parser():
    for html, url in duckdb.sql("SELECT html, url FROM '/root/testdata/sf0.01/pages.parquet'").fetchall():
        other = SecondOpinion()
        other.feed(html)
        other.close()
        assert [t for t, _ in links_of(html, url)] == [urljoin(url, h) for h in other.links]
        assert text_of(html).replace(" ", "") == "".join("".join(other.text).split())


@pytest.mark.parametrize("junk", ["<a ", "</a", "<!", "<!--", "<a b=\"", "<a b='>'", '<a b=">"', "<a b=\"'>", "<", "<base ", "<script>", "<title", "='", "<a href="])
def test_junk_takes_time_by_its_length(junk):
    page = junk * ((1 << 20) // len(junk))
    for work in (lambda: links_of(page, "http://a.com/"), lambda: text_of(page), lambda: replay_copy(page, "http://a.com/", "p/")):
        start = time.time()
        work()
        assert time.time() - start < 5


def test_page_that_ends_inside_quotes_keeps_its_links():
    assert links_of('<a href="/x">t</a><p d=">" e=">"', PAGE)[0] == ("http://www.a.com/x", "t")


BITS = ["<a href='/x'>", '<a href="y>">', "</a>", "<", "<!--", "-->", "<!", "</", "</>", "<script>", "</Script >", "<style>", "</style", "<title>", "</title>",
        "<textarea x='>'>", "</textarea/", "<p>", "<p t='", '"', ">", "='", "text", "\n", "\xa0", "\t  ", "&lt;", "<titlex>", "<base href=http://b.org/>", "<1", "<a"]


def test_pages_in_one_pass_equal_pages_tag_by_tag(monkeypatch):
    chosen = random.Random(3)
    pages = ["".join(chosen.choices(BITS, k=chosen.randint(0, 14))) for _ in range(20_000)]
    found = [(links_of(p, PAGE), text_of(p)) for p in pages]
    monkeypatch.setattr(markup, "tokens", markup._tokens_one_by_one)
    assert found == [(links_of(p, PAGE), text_of(p)) for p in pages]


def test_a_whole_page_takes_one_pass(monkeypatch):
    monkeypatch.setattr(markup, "_tokens_one_by_one", None)
    page = '<!DOCTYPE html><title>T</title><script>a="</p>"</script><!-- n --><p t="a>b">1 < 2<br><a href="/x">t</a>'
    assert (links_of(page, PAGE), text_of(page)) == ([("http://www.a.com/x", "t")], "T 1 < 2 t")
