"""The link report: ten result sets over the five tables.

Reports on links read only the links table where its own columns answer them: every
link belongs to a stored page and points to a stored URL, so joining those in for the
article filter or the target host would shuffle and change nothing.

Ties in a top list are broken by the key, nulls last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.functions import text, urls
from linkloom.profile import SiteProfile
from linkloom.sources.tables import CrawlTables

TOP = 10


def _count() -> Column:
    return F.count(F.lit(1)).alias("cnt")


def _top(counts: DataFrame, key: str, n: int = TOP) -> DataFrame:
    return counts.orderBy(F.desc("cnt"), F.asc_nulls_last(key)).limit(n)


def _article_links(tables: CrawlTables, profile: SiteProfile) -> DataFrame:
    return tables.links.filter(urls.is_article(F.col("from_url"), profile))


def hub_count(tables: CrawlTables, profile: SiteProfile) -> DataFrame:
    return tables.pages.filter(urls.is_hub(F.col("url"), profile)).agg(_count())


def article_count(tables: CrawlTables, profile: SiteProfile) -> DataFrame:
    return tables.pages.filter(urls.is_article(F.col("url"), profile)).agg(_count())


def page_total(tables: CrawlTables) -> DataFrame:
    return tables.pages.agg(_count())


def links_by_type(tables: CrawlTables, profile: SiteProfile) -> DataFrame:
    return _article_links(tables, profile).groupBy("is_internal").agg(_count())


def frontier_status(tables: CrawlTables) -> DataFrame:
    return tables.frontier.groupBy("status").agg(_count())


def top_external_hosts(tables: CrawlTables, profile: SiteProfile, n: int = TOP) -> DataFrame:
    """Hosts that articles link to most."""
    external = _article_links(tables, profile).filter(~F.col("is_internal"))
    per_host = external.groupBy(urls.url_host(F.col("to_url")).alias("host")).agg(_count())
    return _top(per_host, "host", n)


def top_anchors(tables: CrawlTables, profile: SiteProfile, n: int = TOP) -> DataFrame:
    named = _article_links(tables, profile).filter(F.col("anchor_text") != "")
    return _top(named.groupBy("anchor_text").agg(_count()), "anchor_text", n)


def http_status_hist(tables: CrawlTables) -> DataFrame:
    counts = tables.pages.groupBy("http_status").agg(_count())
    return counts.orderBy(F.desc("cnt"), F.asc_nulls_last("http_status"))


def depth_status(tables: CrawlTables) -> DataFrame:
    return tables.frontier.groupBy("depth", "status").agg(_count()).orderBy("depth", "status")


def top_linking_titles(tables: CrawlTables, profile: SiteProfile, n: int = TOP) -> DataFrame:
    """Titles whose article pages link most; pages with equal titles count together."""
    per_page = _article_links(tables, profile).groupBy("from_url").agg(_count())
    titles = tables.pages.select(F.col("url").alias("from_url"), "title")
    per_title = per_page.join(titles, "from_url").groupBy("title").agg(F.sum("cnt").alias("cnt"))
    return _top(per_title, "title", n)


def crawl_report(tables: CrawlTables, profile: SiteProfile) -> DataFrame:
    """All ten result sets as (section, rank, key, cnt), labelled for display."""
    is_article, is_hub = (f(F.col("url"), profile) for f in (urls.is_article, urls.is_hub))
    totals = tables.pages.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_hub).alias("hubs"),
        F.count_if(is_article).alias("articles"),
    ).select(
        F.explode(
            F.array(
                *(
                    F.struct(F.lit(i).alias("rank"), F.lit(k).alias("key"), F.col(k).alias("cnt"))
                    for i, k in enumerate(("total", "hubs", "articles"), 1)
                )
            )
        ).alias("r")
    ).select(F.lit("pages").alias("section"), "r.*")

    kind = F.when(F.col("is_internal"), "internal").otherwise("external")
    depth_key = F.format_string("depth=%d, status=%s", "depth", "status")
    sections = [
        totals,
        _section("links", links_by_type(tables, profile), kind, [F.desc("is_internal")]),
        _section("frontier", frontier_status(tables), F.col("status"), [F.asc("status")]),
        _ranked("external hosts", top_external_hosts(tables, profile), "host"),
        _ranked("anchors", top_anchors(tables, profile), "anchor_text"),
        _ranked("http status", http_status_hist(tables), "http_status", text.status_label),
        _section("depth", depth_status(tables), depth_key, [F.asc("depth"), F.asc("status")]),
        _ranked("linking articles", top_linking_titles(tables, profile), "title", text.title_label),
    ]
    return reduce(DataFrame.unionByName, sections)


def _section(name: str, rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """Number a small result set (a top list or one row per status) for display."""
    return rows.select(
        F.lit(name).alias("section"),
        F.row_number().over(W.orderBy(*order)).alias("rank"),
        key.alias("key"),
        F.col("cnt"),
    )


def _ranked(name: str, rows: DataFrame, key: str, label=lambda c: c) -> DataFrame:
    return _section(name, rows, label(F.col(key)), [F.desc("cnt"), F.asc_nulls_last(key)])
