from datetime import datetime

import pytest

from linkloom import schemas
from linkloom.plans import report
from linkloom.sources.tables import CrawlTables

NOW = datetime(2024, 1, 1)
SITE = "https://portal.test/ru"


def _frame(spark, name, rows):
    """Rows given as dicts; the columns left out are null, false, 0 or now."""
    schema = schemas.TABLES[name]
    default = {"boolean": False, "int": 0, "timestamp": NOW, "string": ""}
    full = [
        tuple(
            r.get(f.name, None if f.nullable else default[f.dataType.simpleString()]) for f in schema
        )
        for r in rows
    ]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="module")
def tables(spark):
    pages = [
        {"url": f"{SITE}/articles/1/", "http_status": 200, "title": "T" * 80},
        {"url": f"{SITE}/companies/c/articles/2/", "http_status": 404, "title": None},
        {"url": f"{SITE}/hubs/h/articles/page3/", "http_status": 200, "title": "Hub"},
        {"url": f"{SITE}/news/4/", "http_status": None, "title": "News"},
    ]
    links = [
        {"from_url": pages[p]["url"], "pos": i, "to_url": to, "anchor_text": text, "is_internal": "portal" in to}
        for i, (p, to, text) in enumerate([
            (0, "https://b.test/x/", "read"), (0, "https://a.test/x/", "read"), (0, "https://a.test:81/y/", ""),
            (1, "https://portal.test/ru/articles/1/", "home"), (1, "https://b.test/z/", None),
            (2, "https://c.test/", "hub link"), (3, "https://c.test/", "news link"),
        ])
    ]
    frontier = [
        {"url": "a", "status": "done", "depth": 0}, {"url": "b", "status": "queued", "depth": 1},
        {"url": "c", "status": "queued", "depth": 1},
    ]
    return CrawlTables(
        _frame(spark, "urls", []), _frame(spark, "frontier", frontier), _frame(spark, "pages", pages),
        _frame(spark, "links", links), _frame(spark, "fetch_attempts", []),
    )


def test_report_sections(tables, profile):
    rows = report.crawl_report(tables, profile).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.section, r["rank"])):
        got.setdefault(r.section, []).append((r.key, r.cnt))
    assert got == {
        "pages": [("total", 4), ("hubs", 1), ("articles", 2)],
        "links": [("internal", 1), ("external", 4)],
        "frontier": [("done", 1), ("queued", 2)],
        "external hosts": [("a.test", 2), ("b.test", 2)],
        "anchors": [("read", 2), ("home", 1)],
        "http status": [("200", 2), ("404", 1), ("N/A", 1)],
        "depth": [("depth=0, status=done", 1), ("depth=1, status=queued", 2)],
        "linking articles": [("T" * 60, 3), ("N/A", 2)],
    }


def test_top_lists_are_cut_after_counting(tables, profile):
    assert [tuple(r) for r in report.top_external_hosts(tables, profile, 1).collect()] == [("a.test", 2)]
    assert [tuple(r) for r in report.top_anchors(tables, profile, 1).collect()] == [("read", 2)]
    assert [tuple(r) for r in report.top_linking_titles(tables, profile, 1).collect()] == [("T" * 80, 3)]
