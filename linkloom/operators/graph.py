"""Link graph: edge table, breadth-first expansion, discovery lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.dedup import crawlable_target, first_contents
from linkloom.operators.html import explode_links
from linkloom.operators.lookup import broadcast_if_small, is_small
from linkloom.operators.skew import hot_keys, salted_join
from linkloom.profile import SiteProfile
from linkloom.scratch import stage


def link_rows(parsed_pages: DataFrame, profile: SiteProfile, *carry: str) -> DataFrame:
    """Rows of the links table: one per anchor occurrence, repeats kept.

    ``parsed_pages`` holds stored pages with url, fetched_at and page_links. Further
    page columns to repeat on each row are named in ``carry``.
    """
    edges = explode_links(parsed_pages, profile, "url", "fetched_at", *carry)
    return edges.select(
        F.col("url").alias("from_url"),
        "pos",
        "to_url",
        "anchor_text",
        "is_internal",
        F.lit(False).alias("nofollow"),
        F.col("fetched_at").alias("discovered_at"),
        *carry,
    )


def breadth_first(
    seeds: DataFrame,
    edges: DataFrame,
    profile: SiteProfile,
    pages: DataFrame | None = None,
    crawlable_only: bool = True,
) -> DataFrame:
    """Discovery depth and first parent of every URL reached from ``seeds`` (url).

    ``edges``: from_url, to_url. ``pages`` (url, content_hash; one row per URL), when
    given, are the stored HTML pages: only URLs that have one follow their links, and
    of pages with equal content only the first by (depth, URL). Without ``pages``
    every reached URL follows its links.

    At most ``max_depth`` rounds, each one join of the new level with the edges, without
    shuffling them while the level is small. Each level is written once, which keeps the
    plan short and survives lost executors. ``edges`` are read once per round: stage
    them when they are costly.
    Offers are reduced to one row per target before the visited lookup, so a target
    that very many pages link to costs one row per task. A level too large to broadcast meets
    the edges in a salted join: the links of a source with very many of them are dealt over
    several tasks by their target, and that source's level row is repeated for each.
    """
    level = stage(
        seeds.select(
            "url", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("discovered_from")
        ).dropDuplicates(["url"]),
        "level",
    )
    visited, seen_hashes = level, None
    links = edges.filter(F.col("from_url") != F.col("to_url"))
    hot = None
    for depth in range(profile.max_depth):
        expanding = level
        if pages is not None:
            wanted = broadcast_if_small(level.select("url"), "url")
            fetched = stage(pages.select("url", "content_hash").join(wanted, "url"), "fetched")
            kept = stage(first_contents(fetched, ["url"], seen_hashes), "kept")
            hashes = kept.select("content_hash")
            seen_hashes = hashes if seen_hashes is None else seen_hashes.unionByName(hashes)
            expanding = kept
        sources = expanding.select(F.col("url").alias("from_url"))
        sources = stage(sources, "sources")
        if is_small(sources, "from_url"):
            joined = links.join(F.broadcast(sources), "from_url")
        else:
            hot = hot if hot is not None else stage(hot_keys(links, "from_url"), "hot-sources")
            joined = salted_join(links, sources, "from_url", ["to_url"], hot)
        offers = joined.select(F.col("to_url").alias("url"), "from_url")
        wanted = crawlable_target(profile) if crawlable_only else F.lit(True).alias("_crawlable")
        reached = (
            offers.groupBy("url")
            .agg(F.min("from_url").alias("discovered_from"), wanted)
            .filter("_crawlable")
            .join(visited.select("url"), "url", "left_anti")
            .select("url", F.lit(depth + 1).alias("depth"), "discovered_from")
        )
        level = stage(reached, "level")
        if level.isEmpty():
            break
        visited = visited.unionByName(level)
    return visited


def discovery_paths(frontier: DataFrame, profile: SiteProfile) -> DataFrame:
    """Add ``path``: the chain of URLs from a seed down to each frontier row.

    Pointer doubling: each row holds the part of its path below an ancestor still to resolve
    (``top``); a round joins every open row with its top's row, prepends that row's part and
    takes over its top, so the resolved part doubles and depth d needs about log2(d) rounds.
    A parent must stand one level above its child, else the child and all below it are left
    out. Parents with very many open children are split by a salted join; each round is written
    to the shared scratch folder.
    """
    rows = frontier.select("url", "depth", "discovered_from").filter(
        (F.col("depth") <= profile.max_depth) & ((F.col("depth") == 0) | F.col("discovered_from").isNotNull())
    )
    now = stage(
        rows.select(
            "url",
            "depth",
            "discovered_from",
            F.when(F.col("depth") > 0, F.col("discovered_from")).alias("top"),
            (F.col("depth") - 1).alias("top_depth"),
            F.array("url").alias("path"),
        ),
        "paths",
    )
    hot = None
    while not now.filter(F.col("top").isNotNull()).isEmpty():
        open_rows = now.filter(F.col("top").isNotNull())
        hot = hot if hot is not None else stage(hot_keys(open_rows, "top"), "hot-parents")
        above = now.select(
            F.col("url").alias("top"),
            F.col("depth").alias("_depth"),
            F.col("top").alias("_up"),
            F.col("top_depth").alias("_up_depth"),
            F.col("path").alias("_above"),
        )
        joined = salted_join(open_rows, above, "top", ["url"], hot).filter(F.col("top_depth") == F.col("_depth"))
        moved = joined.select(
            "url",
            "depth",
            "discovered_from",
            F.col("_up").alias("top"),
            F.col("_up_depth").alias("top_depth"),
            F.concat("_above", "path").alias("path"),
        )
        now = stage(now.filter(F.col("top").isNull()).unionByName(moved), "paths")
    return now.select("url", "depth", "discovered_from", "path")
