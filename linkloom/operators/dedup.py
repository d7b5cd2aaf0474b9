"""URL upsert, content dedup, page rows and frontier admission as set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import urls
from linkloom.operators.lookup import near
from linkloom.profile import SiteProfile
from linkloom.scratch import stage


def url_rows(url: Column, discovered_at: Column, profile: SiteProfile) -> list[Column]:
    """Columns of the urls table for a canonical URL."""
    parts = urls.url_parts(url)
    return [
        url.alias("url"),
        *(parts[name].alias(name) for name in ("scheme", "host", "path", "query")),
        urls.is_internal_url(url, profile).alias("is_internal"),
        discovered_at.alias("discovered_at"),
    ]


def new_urls(found: DataFrame, known: DataFrame, profile: SiteProfile) -> DataFrame:
    """Rows of the urls table for canonical URLs in ``found`` (url, discovered_at) that
    ``known`` does not have yet. Repeats are combined before the shuffle."""
    first_seen = stage(found.groupBy("url").agg(F.min("discovered_at").alias("discovered_at")), "found")
    # Only known URLs that can match are shuffled into the anti-join (lookup.near).
    unseen = first_seen.join(near(known.select("url"), first_seen, "url"), "url", "left_anti")
    return unseen.select(*url_rows(F.col("url"), F.col("discovered_at"), profile))


def rejected_urls(found: DataFrame) -> DataFrame:
    """Canonical URLs that may not enter the urls table, with the reason."""
    return found.withColumn("reason", urls.rejection_reason(F.col("url"))).filter(
        F.col("reason").isNotNull()
    )


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order. The rank filter is applied before
    the shuffle too, so a key with very many rows sends one row per input task."""
    in_order = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(in_order)).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key; rows without a key all stay and are not shuffled.

    ``df`` is read twice: stage it when it is costly.
    """
    first = first_per_key(df.filter(F.col(key).isNotNull()), key, order)
    return first.unionByName(df.filter(F.col(key).isNull()))


def first_contents(
    df: DataFrame, order: list[str], known_hashes: DataFrame | None = None
) -> DataFrame:
    """Drop rows whose ``content_hash`` came earlier in the order or is already stored.

    Copies are reduced to one row per hash first, so the lookup of stored hashes has
    no hot key.
    """
    first = keep_first(df, "content_hash", order)
    if known_hashes is None:
        return first
    stored = known_hashes.select("content_hash").filter(F.col("content_hash").isNotNull())
    return first.join(stored, "content_hash", "left_anti").select(*df.columns)


def page_rows(fetched: DataFrame) -> DataFrame:
    """Rows of the pages table; body and parsed fields only for HTML."""
    html_only = {"content_hash", "title", "meta_description", "html", "text_content"}
    is_html = F.coalesce("is_html", F.lit(False))
    return fetched.select(
        *(
            F.when(is_html, F.col(name)).alias(name)
            if name in html_only
            else (is_html.alias(name) if name == "is_html" else F.col(name))
            for name in schemas.PAGES.fieldNames()
        )
    )


def frontier_rows(
    url: str, depth: Column, priority: Column, parent: Column, at: Column
) -> list[Column]:
    """Columns of a freshly queued frontier row."""
    return [
        F.col(url).alias("url"),
        F.lit("queued").alias("status"),
        depth.cast("int").alias("depth"),
        priority.cast("int").alias("priority"),
        parent.cast("string").alias("discovered_from"),
        at.alias("next_fetch_at"),
        F.lit(0).alias("attempt_count"),
        F.lit(None).cast("string").alias("last_error"),
        at.alias("created_at"),
        at.alias("updated_at"),
    ]


def load_seeds(
    seeds: DataFrame, known: DataFrame, at: Column, profile: SiteProfile
) -> tuple[DataFrame, DataFrame]:
    """New (urls rows, frontier rows) for seed URLs not known yet. Loading twice adds none."""
    canonical = seeds.select(
        urls.normalize_url(F.col("url"), profile).alias("url"), at.alias("discovered_at")
    )
    added = new_urls(canonical, known, profile)
    queued = added.select(
        *frontier_rows(
            "url",
            F.lit(0),
            F.lit(profile.seed_priority),
            F.lit(None),
            F.col("discovered_at"),
        )
    )
    return added, queued


def crawlable_target(profile: SiteProfile) -> Column:
    """The crawl patterns as part of an aggregate by ``url``: they are matched once for each
    target, where the optimizer would push a filter down to every offer."""
    return urls.should_crawl(F.any_value("url"), profile).alias("_crawlable")


def expand_frontier(offers: DataFrame, frontier: DataFrame, profile: SiteProfile) -> DataFrame:
    """Frontier rows for offered link targets.

    ``offers``: url, discovered_from, parent_depth, discovered_at. A target is taken
    if its parent is above the depth limit, it matches a crawl pattern and it is not in
    the frontier; of several parents the first by (depth, URL) counts. Offers of one
    target are combined before the shuffle.
    """
    first = F.min(F.struct("parent_depth", "discovered_from", "discovered_at"))
    offered = stage(
        offers.filter(F.col("parent_depth") < profile.max_depth)
        .groupBy("url")
        .agg(first.alias("first"), crawlable_target(profile))
        .filter("_crawlable"),
        "offered",
    )
    # Only frontier URLs that can match are shuffled into the anti-join (lookup.near).
    taken = offered.join(near(frontier.select("url"), offered, "url"), "url", "left_anti")
    return taken.select(
        *frontier_rows(
            "url",
            F.col("first.parent_depth") + 1,
            F.lit(profile.link_priority),
            F.col("first.discovered_from"),
            F.col("first.discovered_at"),
        )
    )
