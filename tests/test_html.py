import random
from pathlib import Path
from urllib.parse import urljoin

import pyarrow.parquet as pq
import pytest

from stdlib_reader import StdlibReader

from linkloom.operators import html as H

PAGE = """<!doctype html><html lang="ru"><body><h2>Weekly <em>digest</em></h2>
<ul><li><a href="tel:5550100">Ring us</a><li><a href="https://elsewhere.test/shop">Shop</a>
<li><a href="news/45?utm_medium=mail">Issue 45</a><li><a href="mailto:desk@portal.test">Write</a>
<li><a href="javascript:go()">Open</a></ul><title>Digest</title>
<meta content="all the news" name="description"></body></html>"""


def _parse(spark, page, base="https://portal.test/base/"):
    df = spark.createDataFrame([(page, base)], "html string, final_url string")
    return H.parse_pages(df, keep=["final_url"]).collect()[0]


def _links(spark, profile, page, base):
    df = spark.createDataFrame([(page, base)], "html string, final_url string")
    rows = H.explode_links(H.parse_pages(df, keep=[]), profile).orderBy("pos").collect()
    return [(r.to_url, r.anchor_text, r.is_internal) for r in rows]


def test_metadata_text_and_links(spark, profile):
    row = _parse(spark, PAGE)
    assert (row.title, row.meta_description) == ("Digest", "all the news")
    assert row.text_content == "Weekly digest Ring us Shop Issue 45 Write Open Digest"
    assert _links(spark, profile, PAGE, "https://portal.test/base/") == [
        ("https://elsewhere.test/shop/", "Shop", False),
        ("https://portal.test/base/news/45/", "Issue 45", True),
    ]


def test_a_page_without_title_and_description(spark, profile):
    bare = '<p>See <a href="../up">there</a>'
    row = _parse(spark, bare)
    assert row.title is None and row.meta_description is None
    assert _links(spark, profile, bare, "https://portal.test/a/b/") == [
        ("https://portal.test/a/up/", "there", True)
    ]


def test_null_body_gives_null_fields(spark):
    assert list(_parse(spark, None))[1:] == [None] * 5


@pytest.mark.parametrize(
    "page,title,text",
    [
        ("<title> a &amp; b </title>x", " a & b ", "a & b x"),
        ("<title></title><p>x", None, "x"),
        ("<title>a<b>c</b></title>", None, "a c"),
        ("<title>one</title><title>two</title>", "one", "one two"),
        ("a<!-- no -->b<script>var t='</p>';</script><style>p{}</style>c", None, "a b c"),
        ("a<template><p>no</p></template><ruby>k<rt>no</rt></ruby>z", None, "a k z"),
        ("1 < 2 &copy; &#233;", None, "1 < 2 © é"),
        ("<p>cut <a href='/x", None, "cut"),
        ("<p>cut<!-- open", None, "cut"),
        ("x</b>y", None, "xy"),
        ("", None, ""),
    ],
)
def test_title_and_text(spark, page, title, text):
    row = _parse(spark, page)
    assert (row.title, row.text_content) == (title, text)


@pytest.mark.parametrize(
    "page,description",
    [
        ("<meta name=description>", None),
        ("<meta name=description content=''>", ""),
        ("<meta name=Description content=a><META NAME=description CONTENT='b'>", "b"),
        ("<meta name=description content=a><meta name=description content=b>", "a"),
    ],
)
def test_description(spark, page, description):
    assert _parse(spark, page).meta_description == description


@pytest.mark.parametrize(
    "base,href,stored",
    [
        ("https://portal.test/base/", "/ru/articles/123?utm_source=x", "https://portal.test/ru/articles/123/"),
        ("https://portal.test", "/x", "https://portal.test/x/"),
        ("http://h/a/b", "#f", "http://h/a/b/"),
        ("http://h/a/b", "?q=1", "http://h/a/b/?q=1"),
        ("http://h/a/b", "../../../c", "http://h/c/"),
        ("http://h/a/b", "./d;p", "http://h/a/d/"),
        ("http://h/a/b", "//cdn.x/y", "http://cdn.x/y/"),
        ("https://h/a", "HTTP://X/", None),
        ("http://h/a", "HTTP://X/", "http://x/"),
        ("http://h/a", "ftp://z/q", None),
        ("http://h/a/b", "Mailto:x@y", None),
        ("http://h/", "http://[bad/x", None),
        ("http://h/", "http:///p", "http://h/p/"),
        ("http://h/", "http://[::1]/p", None),
        ("http://h/", "http://[fe80::1]:80/p", "http://fe80/p/"),
    ],
)
def test_resolution(spark, profile, base, href, stored):
    got = _links(spark, profile, f'<a href="{href}">t</a>', base)
    assert [u for u, _, _ in got] == ([stored] if stored else [])


def test_rejected_links_are_reported(spark, profile):
    page = '<a href="http://[bad/x">a</a><a href="http://[::1]/">c</a><a href="http://h/">d</a><a href="http:///p">e</a>'
    df = spark.createDataFrame([(page, "http:")], "html string, final_url string")
    got = H.rejected_links(H.parse_pages(df, keep=[]), profile).collect()
    assert {(r.href, r.reason) for r in got} == {
        ("http://[bad/x", "malformed"),
        ("http:///p", "no host"),
        ("http://[::1]/", "no host"),
    }


@pytest.mark.parametrize(
    "page,anchors",
    [
        ("<a href=/a>one <b>two</b> three</a>", ["onetwothree"]),
        ("<a href=/a>one<a href=/b>two</a>", ["one", "two"]),
        ("<p><a href=/a>in</p>out<a href=/b>z", ["in", "z"]),
        ("<a href=/a><script>no()</script>t</a>", ["t"]),
        ("<a href=/a><div>in</a>more</div></a>", ["inmore"]),
        ("<a name=x>no</a><a href=''>no</a><a href>no</a><a href=/y>yes</a>", ["yes"]),
        ("<a href=/a/></a>x", [""]),
        ("<a href=/same>1</a><a href=/same>2</a>", ["1", "2"]),
    ],
)
def test_anchor_text(spark, profile, page, anchors):
    assert [t for _, t, _ in _links(spark, profile, page, "http://h/")] == anchors


def _fields(reader, page):
    reader.read(page)
    return reader.title, reader.description, reader.texts, reader.anchors


def test_reader_agrees_with_the_standard_parser_on_random_markup():
    rng = random.Random(1)
    pieces = [
        "<p>", "</p>", "<P CLASS='x > y'>", "<br>", "<br/>", "<div>", "</div>", "<b>", "</b>", "<title>", "</title>",
        "<a href=/a>", '<a href="/b?x=1&amp;y=2">', "<a href='/c'>", "<a>", "</a>", "<a href=/d/>", '<a href="/e"/>', "<A HREF = /f >",
        "<table>", "<tr>", "<td>", "</td>", "</table>", "<ruby>", "<rt>", "</rt>", "</ruby>", "<template>", "</template>",
        "<script>if (a < b) '</p>'</script>", "<style>p > a {}</style>", "<SCRIPT src=x></SCRIPT>", "<!-- c > d -->", "<!doctype html>", "<?pi x?>",
        "<meta name=description content='d &quot;'>", "<meta name=other content=x>", "</nothing>", "text", " ", "\n", "&amp;", "&#233;", "a &lt; b", "1 < 2",
        "<img src=x alt='>'>", "<ul><li>", "</ul>", "<h1>", "</h1 >", "<x-y z>",
    ]
    for _ in range(4000):
        page = "".join(rng.choice(pieces) for _ in range(rng.randrange(25)))
        assert _fields(H._PageReader(), page) == _fields(StdlibReader(), page), page


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no test tables")
def test_reader_agrees_with_the_standard_parser_on_pages():
    for page in pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"])["html"].to_pylist():
        assert _fields(H._PageReader(), page) == _fields(StdlibReader(), page)


def test_resolution_agrees_with_the_standard_library():
    rng = random.Random(3)
    bases = ["http://h/a/b", "https://h", "http://H:80/x?q#f", "HTTP://h/", "http://u@h/", "http://[::1]/a", "ftp://h/a", "", "http:", "//h/a", "http://h?q"]
    parts = ["/", "/", "a", "é", ".", "..", "?", "#", ";", "http://", "https://", "h.test", ":", "8", " ", "\t", "%20", "//", "ftp:", "[", "-", "b/"]
    for _ in range(40_000):
        base, href = rng.choice(bases), "".join(rng.choice(parts) for _ in range(rng.randrange(1, 7)))
        try:
            want = urljoin(base, href), []
        except ValueError:
            want = "", [href]
        links, malformed = H._resolve(base, [(href, ["t"])])
        kept = [(want[0], "t")] if want[0].startswith(("http://", "https://")) else []
        assert (links, malformed) == (kept, want[1]), (base, href)


@pytest.mark.parametrize("part", ["<", "<a ", "<a href='", "<!--", "<script>", "=\"", "<a x=y", "</", "&"])
def test_reading_time_is_linear(part):
    H._PageReader().read(part * 20_000)
