"""One batch of fetch results applied to the five tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import text, urls
from linkloom.operators import dedup, frontier as fr, graph
from linkloom.operators.html import parse_pages
from linkloom.operators.lookup import broadcast_if_small, near
from linkloom.profile import SiteProfile
from linkloom.scratch import stage
from linkloom.sources.tables import CrawlTables


@dataclass(frozen=True)
class AppliedBatch:
    """What one batch adds: rows for every table (``frontier`` holds changed and new
    rows), and one outcome per URL."""

    added: CrawlTables
    outcomes: DataFrame


def parse_results(results: DataFrame, profile: SiteProfile, bodies: bool = True) -> DataFrame:
    """Fetch results with canonical URL, content hash and parsed fields, written once.

    The body is kept for HTML only; without ``bodies`` neither it nor the text is kept.
    The written table lets each later step read just its columns, so bodies are read
    again only to write the pages.
    """
    usable = F.coalesce("is_html", F.lit(False)) & F.col("error").isNull()
    content = [c for c in schemas.RAW.fieldNames() if c in results.columns and c not in ("url", "fetched_at")]
    prepared = results.withColumns(
        {
            "url": urls.normalize_url(F.col("url"), profile),
            "html": F.when(usable, F.col("html")),
            # The hash leaves nulls out, so it is told where they are.
            "result_tie": F.xxhash64(*(x for c in content for x in (F.isnull(c), F.col(c)))),
        }
    )
    keep = [c for c in prepared.columns if bodies or c != "html"]
    parsed = parse_pages(prepared, keep=keep).withColumns(
        {
            "content_hash": text.content_hash(F.col("text_content")),
            "result_id": F.monotonically_increasing_id(),
        }
    )
    if not bodies:
        parsed = parsed.withColumns(
            {c: F.lit(None).cast("string") for c in ("html", "text_content")}
        )
    return stage(parsed, "parsed")


def apply_results(
    results: DataFrame,
    tables: CrawlTables,
    profile: SiteProfile,
    enforce_robots: bool = False,
    latest: Callable[[DataFrame], DataFrame] | None = None,
) -> AppliedBatch:
    """Route each result: a failure moves the retry state; anything else ends the URL
    and is stored as a page unless its text is stored already; a stored HTML page adds
    its links, their URLs and newly discovered frontier rows.

    Results of one URL are taken in time order up to the one that ends it. Results for
    URLs found in the same batch are applied in a further round, after those of the URLs
    they were found from; there are at most ``max_depth`` such rounds. Results for URLs
    that the frontier does not hold as open are logged but change nothing.

    The frontier may be a history with several rows of a URL; ``latest`` then takes the one
    that counts, from the rows of the batch's URLs only.
    """
    if enforce_robots:
        results = fr.block_disallowed(results, profile)
    parsed = parse_results(results, profile)
    batch_urls = stage(parsed.select("url").distinct(), "batch_urls")
    known_hashes = tables.pages.select("content_hash")
    of_batch = tables.frontier.join(broadcast_if_small(batch_urls, "url"), "url", "left_semi")
    known = latest(of_batch) if latest else of_batch
    entries = stage(known.filter(F.col("status").isin("queued", "fetching")), "entries")

    rounds: list[_Round] = []
    frontier: list[DataFrame] = []
    seen = tables.frontier
    for number in range(profile.max_depth + 1):
        done = _apply_round(parsed, entries, known_hashes, seen, profile)
        rounds.append(done)
        frontier.append(
            fr.apply_states(entries, done.states)
            if number == 0
            else fr.replace_rows(entries, fr.apply_states(entries, done.states))
        )
        entries = stage(done.discovered, "discovered")
        if entries.join(batch_urls, "url", "left_semi").isEmpty():
            break
        known_hashes = known_hashes.unionByName(done.stored.select("content_hash"))
        seen = seen.select("url").unionByName(entries.select("url"))
    frontier.append(entries)

    stored, edges, outcomes = (
        _union(getattr(r, name) for r in rounds) for name in ("stored", "edges", "outcomes")
    )
    # The only join that bodies take part in: with stored ids small enough to broadcast
    # they are not shuffled.
    ids = broadcast_if_small(stored.select("result_id"), "result_id")
    targets = stage(
        edges.groupBy(F.col("to_url").alias("url")).agg(F.min("discovered_at").alias("discovered_at")),
        "targets",
    )
    added = CrawlTables(
        urls=dedup.new_urls(targets, near(tables.urls, targets, "url"), profile),
        frontier=_union(frontier),
        pages=dedup.page_rows(parsed.join(ids, "result_id", "left_semi")),
        links=edges.drop("depth"),
        fetch_attempts=fr.attempt_rows(parsed),
    )
    return AppliedBatch(added, outcomes)


@dataclass(frozen=True)
class _Round:
    """Results applied to one set of frontier rows."""

    states: DataFrame
    stored: DataFrame
    edges: DataFrame
    discovered: DataFrame
    outcomes: DataFrame


def _apply_round(
    parsed: DataFrame,
    entries: DataFrame,
    known_hashes: DataFrame,
    frontier: DataFrame,
    profile: SiteProfile,
) -> _Round:
    attempts = parsed.select(
        "url",
        F.col("fetched_at").alias("attempted_at"),
        "result_id",
        "result_tie",
        text.attempt_success(F.col("error")).alias("success"),
        F.col("error").alias("error_message"),
    )
    # Results of one time go by their content, successes first, never by the order of rows.
    order = ("error_message", "result_tie")
    deciding = fr.first_attempts(attempts, profile, "result_id", order).drop("_rank")
    before = entries.select("url", "attempt_count", "next_fetch_at", "last_error")
    folded = fr.fold_attempts(deciding.join(before, "url"), profile, "result_id", order)
    states = stage(folded, "states")

    ended = states.filter("status = 'done'").select(F.col("last_used").alias("result_id"), "url")
    fetched = stage(
        parsed.select("result_id", "fetched_at", "content_hash", "is_html")
        .join(ended, "result_id")
        .join(entries.select("url", "depth"), "url"),
        "fetched",
    )
    known = near(known_hashes, fetched, "content_hash")
    stored = stage(dedup.first_contents(fetched, ["fetched_at", "url"], known), "stored")

    kept = broadcast_if_small(
        stored.select("result_id", "url", "fetched_at", "depth"), "result_id"
    )
    linking = parsed.select("result_id", "page_links").join(kept, "result_id")
    edges = stage(graph.link_rows(linking, profile, "depth"), "edges")
    offers = edges.select(
        F.col("to_url").alias("url"),
        F.col("from_url").alias("discovered_from"),
        F.col("depth").alias("parent_depth"),
        "discovered_at",
    )
    offered = edges.select(F.col("to_url").alias("url"))
    discovered = dedup.expand_frontier(offers, near(frontier, offered, "url"), profile)

    outcome = (
        F.when(F.col("status") == "queued", "retry")
        .when(F.col("status") == "failed", "gave up")
        .when(F.col("_html").isNull(), "duplicate")
        .when(F.col("_html"), "page")
        .otherwise("other page")
    )
    pages = stored.select(
        F.col("result_id").alias("last_used"), F.coalesce("is_html", F.lit(False)).alias("_html")
    )
    outcomes = states.join(pages, "last_used", "left").select(
        "url", "status", outcome.alias("outcome"), F.col("updated_at").alias("decided_at")
    )
    return _Round(states, stored, edges, discovered, outcomes)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def merge(tables: CrawlTables, added: CrawlTables) -> CrawlTables:
    """The five tables after a batch. Write them as a new snapshot before the next one:
    otherwise every batch adds its plan to the last."""
    return CrawlTables(
        urls=tables.urls.unionByName(added.urls),
        frontier=fr.replace_rows(tables.frontier, added.frontier),
        pages=tables.pages.unionByName(added.pages),
        links=tables.links.unionByName(added.links),
        fetch_attempts=tables.fetch_attempts.unionByName(added.fetch_attempts),
    )
