import random
from urllib.parse import parse_qs, urlencode, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from linkloom import SiteProfile
from linkloom.functions import urls as U


def _column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, url string")
    out = rows.select("i", build(F.col("url")).alias("x")).orderBy("i").collect()
    return [r.x for r in out]


# Fixed vectors of the canonical form.
CANONICAL = [
    ("HTTPS://PORTAL.TEST/ru/articles/123?utm_source=x&b=2&a=1", "https://portal.test/ru/articles/123/?a=1&b=2"),
    ("http://Example.com:8080/path", "http://example.com:8080/path/"),
    ("xmpp:someone@mail.test", "xmpp:someone@mail.test/"),
    ("http://h/p;x?a=1#f", "http://h/p/?a=1"),
    ("http://[::1]:80/x", "http://::1:80/x/"),
    ("http://u:p@H:080/x", "http://h:80/x/"),
    ("http://h:99999/x", "http://h/x/"),
    ("http://h:0/", "http://h/"),
    ("http://h:443", "http://h:443/"),
    ("http://h/p?b=2&a=%20x&a=1&c&utm_Source=1&d=*~", "http://h/p/?a=+x&a=1&b=2&c=&d=%2A~"),
    ("http://h/?q=%zz&e=%C3%A9", "http://h/?e=%C3%A9&q=%25zz"),
    ("http://h/?a==b&&x", "http://h/?a=%3Db&x="),
    ("http://h/é ?я=ж", "http://h/é /?%D1%8F=%D0%B6"),
    ("/ru/articles/1", "/ru/articles/1/"),
    ("http:///p", "http:///p/"),
    ("http://h/a.pdf", "http://h/a.pdf/"),
    ("http://h/?z=1;y=2", "http://h/?z=1%3By%3D2"),
    ("http://[bad/x", "http://[bad/x"),
]


def test_canonical_vectors(spark, profile):
    got = _column(spark, [u for u, _ in CANONICAL], lambda c: U.normalize_url(c, profile))
    assert got == [want for _, want in CANONICAL]


def _stdlib_canonical(url, tracking):
    """The wanted form, spelled with the standard library."""
    try:
        parts = urlparse(url)
        host = parts.hostname or ""
        try:
            port = parts.port
        except ValueError:
            port = None
        values = parse_qs(parts.query, keep_blank_values=True)
        pairs = [(k, v) for k in sorted(values) if k.lower() not in tracking for v in values[k]]
        netloc = host.lower() + (f":{port}" if port else "")
        path = parts.path if parts.path.endswith("/") else parts.path + "/"
        return urlunparse((parts.scheme, netloc, path, "", urlencode(pairs), ""))
    except ValueError:
        return url


def test_canonical_form_agrees_with_the_standard_library(spark, profile):
    rng = random.Random(7)
    schemes = ["http://", "HTTPS://", "//", "ftp://", "", "mailto:", "http:", "x-y:", "svn+ssh://", "1a:", "tel:", "file:///"]
    hosts = ["h", "A.b_c.Test", "u:p@H", "[::1]", "[fe80::1%25En0]", "[::ffff:1.2.3.4]", "[v1.x]", "[1.2.3.4]", "[zz]",
             "[1:2:3:4:5:6:7:8]", "[1:2:3:4:5:6:7:8:9]", "[1::2::3]", "[::]", "bad]", "[bad", "é.test", "a／b", "", "a@b@c", "℀", "[12345::]", "[1:2:3:4:5:6:1.2.3.4]"]
    ports = ["", ":80", ":0", ":", ":65535", ":65536", ":00443", ":x", ":8 0", ":99999999999"]
    paths = ["", "/", "/a", "/a/b.html", "/a;p/b;q;r", "//x", "/é ж", "/%7e%zz", "/a\tb", ";x", "/a:b", "/x/../y"]
    queries = ["", "?", "?a=1", "?b=2&a=1&b=1", "?UTM_Source=1&c", "?q=%zz&%C3%A9=%ff", "?a+b=c%2Bd&~=*", "?=1&&=2", "?a=b=c", "?x=1;y=2", "?я=ж", "?a?b=/"]
    tails = ["", "#", "#f?x", " "]
    sample = {"".join(rng.choice(p) for p in (schemes, hosts, ports, paths, queries, tails)) for _ in range(4000)}
    sample |= {"".join(rng.choice("ab:/?#[]@%&=;+.~*é \n1") for _ in range(rng.randint(0, 14))) for _ in range(4000)}
    sample = sorted(sample)
    got = _column(spark, sample, lambda c: U.normalize_url(c, profile))
    want = [_stdlib_canonical(u, profile.tracking_params) for u in sample]
    diff = [(u, g, w) for u, g, w in zip(sample, got, want) if g != w]
    assert not diff, diff[:10]


def test_parts_agree_with_the_standard_library(spark, profile):
    sample = ["http://h", "https://a.b#x/y", "http://h/p/q/#f", "http://a/b#", "http://H:80/a;p?q=1#f", "x:y", "http:///p/", "//h/x", "http://u@h", "/p?x", "https://a.b/c?d=e&f"]
    want = [(p.scheme, p.hostname, p.path, p.query) for p in map(urlparse, sample)]
    got = zip(*(_column(spark, sample, f) for f in (U.url_scheme, U.url_host, U.url_path, U.url_query)))
    assert list(got) == want


@pytest.mark.parametrize("strict,expected", [(False, [True, True, False, False, True]), (True, [True, True, False, False, False])])
def test_internal(spark, strict, expected):
    site = SiteProfile(host_suffix="portal.test", strict_host=strict)
    sample = ["https://portal.test/ru/articles/1/", "https://career.portal.test/vacancies/", "https://example.com/", "/relative/path", "http://evilportal.test/"]
    assert _column(spark, sample, lambda c: U.is_internal_url(c, site)) == expected


CRAWLABLE = [
    ("https://portal.test/ru/articles/123/", True),
    ("https://portal.test/ru/articles/123", False),
    ("https://portal.test/en/articles/123/", False),
    ("https://portal.test/x/ru/articles/1/", False),
    ("https://portal.test/ru/companies/acme/articles/123/", True),
    ("https://portal.test/ru/companies/articles/1/", False),
    ("https://portal.test/ru/hubs/ml/articles/page23/", False),
    ("https://portal.test/ru/hubs/ml/articles/", False),
    ("https://portal.test/ru/hubs/ml/articles//page23/", True),
    ("https://portal.test/ru/hubs/ml/articles//", True),
    ("https://evilportal.test/ru/articles/1/", True),
    ("ftp://portal.test/ru/articles/1/", True),
    ("https://career.portal.test/ru/articles/1/", True),
    ("xmpp:a@b.com/ru/articles/1/", False),
    ("https://www.other.test/ru/articles/123/", False),
    ("https://portal.test/ru/articles/123/comments/", False),
    ("https://portal.test/ru/news/123/", False),
    ("https://portal.test/ru/articles/١٢/", True),
]


def test_crawlable(spark, profile):
    got = _column(spark, [u for u, _ in CRAWLABLE], lambda c: U.should_crawl(c, profile))
    assert got == [want for _, want in CRAWLABLE]


def test_robots(spark, profile):
    sample = ["https://portal.test/ru/articles/1/", "https://portal.test/search/", "https://portal.test/api/x", "https://portal.test/apis", "https://example.com/ru/articles/1/"]
    assert _column(spark, sample, lambda c: U.is_allowed(c, profile)) == [True, False, False, True, False]


def test_page_kind_is_case_sensitive(spark, profile):
    sample = ["https://x/ru/articles/1/", "https://x/RU/articles/1/", "https://x/ru/companies/c/articles/2/", "https://x/ru/hubs/h/articles/page3/"]
    assert _column(spark, sample, lambda c: U.is_article(c, profile)) == [True, False, True, False]
    assert _column(spark, sample, lambda c: U.is_hub(c, profile)) == [False, False, False, True]


def test_admission(spark):
    sample = ["https://a/", "http:///p/", "xmpp:a@b/", "/x/", "ftp://a/"]
    assert _column(spark, sample, U.rejection_reason) == [None, "no host", "unsupported scheme", "unsupported scheme", "unsupported scheme"]
