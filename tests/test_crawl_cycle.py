"""A crawl in cycles: pick, fetch (here: made up), apply, report."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from test_ingest import NOW, article, page, raw, result, snapshot

from linkloom import SiteProfile
from linkloom.operators import dedup, frontier as fr
from linkloom.operators.ingest import apply_results, merge
from linkloom.plans import report
from linkloom.sources import tables as T


def test_cycle(spark, tmp_path):
    site = SiteProfile(host_suffix="portal.test", seed_first_page=21, seed_last_page=23)
    start = T.empty_tables(spark)
    urls, queued = dedup.load_seeds(T.seed_urls(spark, site), start.urls, F.lit(NOW), site)
    tables = T.CrawlTables(urls, queued, start.pages, start.links, start.fetch_attempts)
    tables = snapshot(spark, tables, tmp_path / "0")

    # The second seed is a copy of the first, the third fails.
    due = F.lit(NOW + timedelta(minutes=1))
    picked = fr.next_batch(tables.frontier, tables.urls, due, 10)
    seeds = sorted(r.url for r in picked.collect())
    assert [u.rsplit("/", 2)[1] for u in seeds] == ["page21", "page22", "page23"]
    marked = fr.mark_fetching(tables.frontier, picked)
    assert fr.next_batch(marked, tables.urls, due, 10).count() == 0
    listing = page("list", article(1), article(2), "https://other.test/x")
    rows = [result(seeds[0], 1, listing), result(seeds[1], 2, listing), result(seeds[2], 3, error="timed out")]
    applied = apply_results(raw(spark, rows), tables, site)
    tables = snapshot(spark, merge(tables, applied.added), tmp_path / "1")

    # The failed seed comes first again once its pause is over, then the articles.
    picked = fr.next_batch(tables.frontier, tables.urls, F.lit(NOW + timedelta(seconds=7)), 10)
    assert {r.url for r in picked.collect()} == {article(1), article(2)}
    picked = fr.next_batch(tables.frontier, tables.urls, F.lit(NOW + timedelta(seconds=8)), 1)
    assert [r.url for r in picked.collect()] == [seeds[2]]

    rows = [
        result(article(1), 20, page("one", "https://other.test/y", article(3))),
        result(article(2), 21, page("two", "https://third.test/")),
        # Found on the first article, in the same batch; its own links are too deep.
        result(article(3), 22, page("three", article(4))),
    ]
    applied = apply_results(raw(spark, rows), tables, site)
    tables = snapshot(spark, merge(tables, applied.added), tmp_path / "2")
    frontier = {r.url: (r.status, r.depth) for r in tables.frontier.collect()}
    assert frontier == {
        seeds[0]: ("done", 0), seeds[1]: ("done", 0), seeds[2]: ("queued", 0),
        article(1): ("done", 1), article(2): ("done", 1), article(3): ("done", 2),
    }
    assert tables.pages.count() == 4
    assert tables.fetch_attempts.count() == 6
    assert [tuple(r) for r in report.top_external_hosts(tables, site).collect()] == [
        ("other.test", 1), ("third.test", 1),
    ]
    assert {tuple(r) for r in report.links_by_type(tables, site).collect()} == {(True, 2), (False, 2)}
    assert report.hub_count(tables, site).first().cnt == 1
    assert tables.frontier.agg(F.min("created_at")).first()[0] == datetime(2024, 1, 1)
