"""The link report kept up to date by a stream: mergeable counts per micro-batch.

Each micro-batch writes the counts its rows add to the report (pages by kind and HTTP status,
article links by type, target host, anchor text and page title) and, for the frontier, +1 for
each row it writes and -1 for the row of the same URL it replaces. Counts are kept per key, not
per top list, so summing the folders of all committed batches gives every count exactly, and
the top lists are taken from the sums. The folders hold one row per key and batch: they grow
with the distinct keys, not with the pages or links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.functions import text, urls
from linkloom.plans.report import TOP
from linkloom.profile import SiteProfile
from linkloom.sources.tables import CrawlTables

COUNTS = "section string, skey string, nkey bigint, cnt bigint"


def _rows(df: DataFrame, section: str, skey: Column | None, nkey: Column | None) -> DataFrame:
    return df.groupBy(
        F.lit(section).alias("section"),
        (skey if skey is not None else F.lit(None).cast("string")).alias("skey"),
        (nkey if nkey is not None else F.lit(None).cast("bigint")).cast("bigint").alias("nkey"),
    ).agg(F.count(F.lit(1)).alias("cnt"))


def _frontier_rows(frontier: DataFrame, sign: int) -> list[DataFrame]:
    signed = [
        _rows(frontier, "frontier", F.col("status"), None),
        _rows(frontier, "depth", F.col("status"), F.col("depth")),
    ]
    return [df.withColumn("cnt", F.col("cnt") * sign) for df in signed]


def counts(added: CrawlTables, replaced_frontier: DataFrame | None, profile: SiteProfile) -> DataFrame:
    """What the rows of ``added`` add to the report; ``replaced_frontier`` are the frontier rows
    they replace (the latest earlier row of each of their URLs)."""
    pages = added.pages
    url = F.col("url")
    totals = pages.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(urls.is_hub(url, profile)).alias("hubs"),
        F.count_if(urls.is_article(url, profile)).alias("articles"),
    ).select(
        F.explode(
            F.array(*(F.struct(F.lit(k).alias("skey"), F.col(k).alias("cnt")) for k in ("total", "hubs", "articles")))
        ).alias("r")
    ).select(F.lit("pages").alias("section"), "r.skey", F.lit(None).cast("bigint").alias("nkey"), "r.cnt")
    article_links = added.links.filter(urls.is_article(F.col("from_url"), profile))
    named = article_links.filter(F.col("anchor_text") != "")
    external = article_links.filter(~F.col("is_internal"))
    per_page = article_links.groupBy("from_url").agg(F.count(F.lit(1)).alias("n"))
    titles = pages.select(F.col("url").alias("from_url"), "title")
    per_title = per_page.join(titles, "from_url").groupBy(F.col("title")).agg(F.sum("n").alias("cnt"))
    parts = [
        totals,
        _rows(pages, "http status", None, F.col("http_status")),
        _rows(article_links, "links", None, F.col("is_internal").cast("int")),
        _rows(external, "external hosts", urls.url_host(F.col("to_url")), None),
        _rows(named, "anchors", F.col("anchor_text"), None),
        per_title.select(
            F.lit("linking articles").alias("section"), F.col("title").alias("skey"),
            F.lit(None).cast("bigint").alias("nkey"), F.col("cnt").cast("bigint"),
        ),
        *_frontier_rows(added.frontier, 1),
    ]
    if replaced_frontier is not None:
        parts += _frontier_rows(replaced_frontier, -1)
    return reduce(DataFrame.unionByName, parts)


def _section(name: str, rows: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    return rows.select(
        F.lit(name).alias("section"),
        F.row_number().over(W.orderBy(*order)).alias("rank"),
        key.alias("key"),
        F.col("cnt"),
    )


def report(all_counts: DataFrame) -> DataFrame:
    """(section, rank, key, cnt) as ``report.crawl_report`` gives them, from summed counts."""
    summed = all_counts.groupBy("section", "skey", "nkey").agg(F.sum("cnt").alias("cnt"))
    summed = summed.filter(F.col("cnt") != 0).cache()

    def part(name: str) -> DataFrame:
        return summed.filter(F.col("section") == name)

    def top(name: str, key: Column, label: Column | None = None) -> DataFrame:
        rows = part(name).withColumn("k", key).orderBy(F.desc("cnt"), F.asc_nulls_last("k")).limit(TOP)
        return _section(name, rows, label if label is not None else F.col("k"), [F.desc("cnt"), F.asc_nulls_last("k")])

    order = F.array_position(F.array(*(F.lit(k) for k in ("total", "hubs", "articles"))), F.col("skey"))
    pages = summed.filter(F.col("section") == "pages")
    totals = (
        F.broadcast(
            all_counts.sparkSession.createDataFrame([(k,) for k in ("total", "hubs", "articles")], "skey string")
        )
        .join(pages.select("skey", "cnt"), "skey", "left")
        .select(F.lit("pages").alias("section"), order.cast("int").alias("rank"), F.col("skey").alias("key"),
                F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"))
    )
    kind = F.when(F.col("nkey") == 1, "internal").otherwise("external")
    depth_key = F.format_string("depth=%d, status=%s", F.col("nkey"), F.col("skey"))
    statuses = part("http status")
    sections = [
        totals,
        _section("links", part("links"), kind, [F.desc("nkey")]),
        _section("frontier", part("frontier"), F.col("skey"), [F.asc("skey")]),
        top("external hosts", F.col("skey")),
        top("anchors", F.col("skey")),
        _section(
            "http status", statuses, text.status_label(F.col("nkey")), [F.desc("cnt"), F.asc_nulls_last("nkey")]
        ),
        _section("depth", part("depth"), depth_key, [F.asc("nkey"), F.asc("skey")]),
        top("linking articles", F.col("skey"), None).withColumn("key", text.title_label(F.col("key"))),
    ]
    return reduce(DataFrame.unionByName, sections)
