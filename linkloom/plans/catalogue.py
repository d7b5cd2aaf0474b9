"""Every operator as a query over a folder of tables: name -> f(spark, folder)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import text, urls
from linkloom.operators import dedup, frontier as fr, graph
from linkloom.operators.html import explode_links, parse_pages, rejected_links
from linkloom.operators.ingest import apply_results
from linkloom.plans import report
from linkloom.scratch import scratch_path, stage
from linkloom.sources import corpus
from linkloom.sources.corpus import PROFILE, naive, table
from linkloom.sources.tables import CrawlTables, empty_tables, read_tables, update_tables, write_tables
from linkloom.sources.tables import seed_urls as generated_seeds
from linkloom.streaming import replay, states, store

BATCH_SIZE = 50
FIRST_BATCH = 10
PAGE_BUDGET = 500
AUDIT_GAP_SEC = 600
BATCH_DUE = "timestamp_ntz'2024-01-15 00:00:00'"

_LINK_COLUMNS = ["from_url", "pos", "to_url", "anchor_text", "is_internal", "nofollow"]


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def _canonical(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select(
        "page_id", "url", urls.normalize_url(F.col("url"), PROFILE).alias("canonical")
    )


# Sources and URL functions


def raw_pages(spark, folder):
    results = corpus.page_results(_pages(spark, folder))
    return results.select(
        "url", "http_status", "content_type", "content_length", "is_html", "error",
        naive("fetched_at").alias("fetched_at"), F.sha2("html", 256).alias("body_hash"),
    )


def seed_urls(spark, folder):
    """Hub pages of the corpus, from which a crawl starts."""
    url = F.col("canonical")
    hubs = _canonical(spark, folder).filter(urls.is_hub(url, PROFILE))
    return hubs.select(url.alias("url")).distinct()


def list_seeds(spark, folder):
    """The profile's list pages a crawl starts from, canonical, and whether the corpus holds each."""
    seeds = generated_seeds(spark, PROFILE).select(urls.normalize_url(F.col("url"), PROFILE).alias("url"))
    held = _canonical(spark, folder).select(F.col("canonical").alias("url"), F.lit(True).alias("held")).distinct()
    return seeds.distinct().join(held, "url", "left").select("url", F.coalesce("held", F.lit(False)).alias("held"))


def normalize_url(spark, folder):
    return _canonical(spark, folder)


def url_parts(spark, folder):
    parts = _canonical(spark, folder).select("page_id", urls.url_parts(F.col("canonical")).alias("p"))
    return parts.select("page_id", "p.*")


def url_internal(spark, folder):
    flag = urls.is_internal_url(F.col("canonical"), PROFILE).alias("is_internal")
    return _canonical(spark, folder).select("page_id", flag)


def crawlable_urls(spark, folder):
    flag = urls.should_crawl(F.col("canonical"), PROFILE).alias("crawlable")
    return _canonical(spark, folder).select("page_id", flag)


def robots_allowed(spark, folder):
    flag = urls.is_allowed(F.col("url"), PROFILE).alias("allowed")
    return _canonical(spark, folder).select("page_id", flag)


def page_kind(spark, folder):
    url = F.col("canonical")
    return _canonical(spark, folder).select(
        "page_id",
        urls.is_article(url, PROFILE).alias("is_article"),
        urls.is_hub(url, PROFILE).alias("is_hub"),
    )


def invalid_urls(spark, folder):
    """Admission of each page URL as it is, without its scheme, as a path, as an address
    of another scheme and without host."""
    url = F.col("url")
    rest = F.regexp_replace(url, "^https?:", "")
    path = F.regexp_replace(rest, "^//[^/]*", "")
    host = F.regexp_extract(rest, "^//([^/]*)", 1)
    forms = F.array(
        url,
        rest,
        path,
        F.concat(F.lit("xmpp:bot@"), host),
        F.concat(F.lit("http://"), path),
    )
    found = _pages(spark, folder).select("page_id", F.posexplode(forms).alias("form", "raw"))
    canonical = found.select("page_id", "form", urls.normalize_url(F.col("raw"), PROFILE).alias("url"))
    return dedup.rejected_urls(canonical)


def resolve_links(spark, folder):
    parsed = corpus.parsed_pages(spark, folder, "page_id")
    links = parsed.select("page_id", F.posexplode("page_links").alias("pos", "link"))
    return links.select("page_id", "pos", F.col("link.url").alias("resolved"))


def content_hash(spark, folder):
    hashed = text.content_hash(F.col("text")).alias("content_hash")
    return table(spark, folder, "documents").select("doc_id", hashed)


def _event_key() -> Column:
    return F.col("user_id").cast("string")


def attempt_errors(spark, folder):
    results = corpus.event_results(table(spark, folder, "events"), _event_key())
    error = F.col("error")
    return results.select(
        "event_id",
        text.attempt_success(error).alias("success"),
        text.error_type(error).alias("error_type"),
    )


# HTML


def page_titles(spark, folder):
    parsed = corpus.parsed_pages(spark, folder, "page_id")
    return parsed.select("page_id", "title", "meta_description")


def page_text(spark, folder):
    return corpus.parsed_pages(spark, folder, "page_id").select("page_id", "text_content")


def page_links(spark, folder):
    return explode_links(corpus.parsed_pages(spark, folder, "page_id"), PROFILE, "page_id")


def _mixed_pages(spark, folder) -> DataFrame:
    """Parsed pages with a description and links of every kind put before their html."""
    number = F.col("page_id").cast("string")
    head = F.concat(
        F.lit('<meta name="description" content="About page '), number,
        F.lit('"><a href="http://CDN.example.org/f'), number, F.lit('?b=2&a=1">cdn</a>'),
        F.lit('<a href="mailto:a@b.example">m</a><a href="tel:5">t</a><a href="javascript:f()">j</a>'),
        F.lit('<a href="ftp://b.example/f">f</a><a href="http://:80/x">h</a><a href="http://[x">b</a>'),
    )
    pages = corpus.spread(_pages(spark, folder)).withColumn("html", F.concat(head, "html"))
    return parse_pages(pages, base="url", keep=["page_id"])


def page_descriptions(spark, folder):
    return _mixed_pages(spark, folder).select("page_id", "meta_description")


def mixed_links(spark, folder):
    return explode_links(_mixed_pages(spark, folder), PROFILE, "page_id")


def links_rejected(spark, folder):
    return rejected_links(_mixed_pages(spark, folder), PROFILE, "page_id")


# Dedup and upsert


def upsert_urls(spark, folder):
    """URLs that links add to the URLs of the pages themselves."""
    known = _canonical(spark, folder).select(F.col("canonical").alias("url")).distinct()
    links = page_links(spark, folder)
    found = links.select(
        F.col("to_url").alias("url"), corpus.seconds_in(F.col("page_id")).alias("discovered_at")
    )
    added = dedup.new_urls(found, known, PROFILE)
    return added.withColumn("discovered_at", naive("discovered_at"))


def _hashed_documents(spark, folder) -> DataFrame:
    """Hashed once, so that texts are read once."""
    return stage(content_hash(spark, folder), "hashes")


def dedup_content(spark, folder):
    return dedup.first_contents(_hashed_documents(spark, folder), ["doc_id"])


def page_rows(spark, folder):
    pages = dedup.page_rows(corpus.stored_pages(spark, folder))
    return pages.withColumn("fetched_at", naive("fetched_at"))


def load_seeds(spark, folder):
    """Queue every page that is not on the site itself."""
    known = _canonical(spark, folder).filter(urls.is_internal_url(F.col("canonical"), PROFILE))
    at = corpus.seconds_in(F.col("page_id"))
    seeds = _pages(spark, folder)
    canonical_known = known.select(F.col("canonical").alias("url"))
    _, queued = dedup.load_seeds(seeds, canonical_known, at, PROFILE)
    return _frontier_view(queued)


def _frontier_view(frontier: DataFrame) -> DataFrame:
    naive_columns = {c: naive(c) for c in ("next_fetch_at", "created_at", "updated_at")}
    return frontier.withColumns(naive_columns)


def expand_frontier(spark, folder):
    frontier = corpus.crawl_tables(spark, folder).frontier
    return _frontier_view(frontier.filter("depth > 0"))


# Link graph


def link_graph(spark, folder):
    return corpus.crawl_tables(spark, folder).links.select(*_LINK_COLUMNS)


def _site_levels(spark, folder) -> DataFrame:
    return graph.breadth_first(
        seed_urls(spark, folder), corpus.site_edges(spark, folder), PROFILE, crawlable_only=False
    )


def bfs_depth(spark, folder):
    return _site_levels(spark, folder).select("url", "depth")


def discovery_tree(spark, folder):
    paths = graph.discovery_paths(_site_levels(spark, folder), PROFILE)
    return paths.select(
        "url", "depth", "discovered_from", F.array_join("path", " > ").alias("path")
    )


def bfs_pruned(spark, folder):
    """Levels when copies do not follow their links; contents are told apart by a few numbers."""
    pages = _canonical(spark, folder).select(
        F.col("canonical").alias("url"), F.concat(F.lit("text "), F.col("page_id") % 5).alias("content_hash")
    )
    root = corpus.site_root(F.col("url"))
    roots = pages.select(root.alias("url"), F.concat(F.lit("root "), F.length(root) % 3).alias("content_hash"))
    contents = pages.unionByName(roots).groupBy("url").agg(F.min("content_hash").alias("content_hash"))
    return graph.breadth_first(
        seed_urls(spark, folder), corpus.site_edges(spark, folder), PROFILE,
        pages=stage(contents, "contents"), crawlable_only=False,
    )


# Frontier


def _daily_frontier(spark, folder) -> tuple[DataFrame, DataFrame]:
    """A frontier with one URL per user and day, and its urls table."""
    day = F.date_format("ts", "yyyyMMdd")
    url = F.concat(F.lit("https://u"), _event_key(), F.lit(".example.com/en/"), day, F.lit("/"))
    attempts = corpus.event_attempts(table(spark, folder, "events"), url)
    folded = fr.fold_attempts(attempts, PROFILE, "event_id")
    depth = F.when(F.col("attempt_count") == 1, 1).otherwise(0)
    frontier = folded.withColumn("depth", depth).withColumn(
        "priority", F.when(depth == 0, PROFILE.seed_priority).otherwise(PROFILE.link_priority)
    )
    frontier = stage(frontier, "daily")
    hosts = frontier.select("url", urls.url_host(F.col("url")).alias("host"))
    return frontier, hosts


def next_batch(spark, folder):
    frontier, hosts = _daily_frontier(spark, folder)
    due = F.expr(BATCH_DUE).cast("timestamp")
    picked = fr.next_batch(frontier, hosts, due, BATCH_SIZE)
    return picked.select(
        "url", "host", "status", "priority", "depth", naive("next_fetch_at").alias("next_fetch_at")
    )


def next_batch_again(spark, folder):
    """The batch after the first, picked from the snapshot the first one leaves."""
    frontier, hosts = _daily_frontier(spark, folder)
    frontier = frontier.withColumns(
        {"discovered_from": F.lit(None).cast("string"), "created_at": F.col("updated_at")}
    ).select(*schemas.FRONTIER.fieldNames())
    due = F.expr(BATCH_DUE).cast("timestamp")
    first = stage(fr.next_batch(frontier, hosts, due, FIRST_BATCH), "first-batch")
    picked = fr.next_batch(fr.mark_fetching(frontier, first), hosts, due, BATCH_SIZE)
    return picked.select("url", "host", "status", "priority", "depth")


def politeness_slots(spark, folder):
    """Slots for all link targets and pages, first by whether they are pages."""
    pages = _canonical(spark, folder).select(F.col("canonical").alias("url"), F.lit(0).alias("depth"))
    links = page_links(spark, folder).select(F.col("to_url").alias("url"), F.lit(1).alias("depth"))
    merged = pages.unionByName(links).groupBy("url").agg(F.min("depth").alias("depth"))
    candidates = merged.select(
        "url",
        "depth",
        F.when(F.col("depth") == 0, 10).otherwise(100).alias("priority"),
        urls.url_host(F.col("url")).alias("host"),
    )
    slots = fr.politeness_slots(candidates, PROFILE)
    return slots.select("url", "host", "slot", "offset_sec")


def politeness_audit(spark, folder):
    attempts = corpus.event_attempts(table(spark, folder, "events"), _event_key())
    log = attempts.select("event_id", F.col("url").alias("host"), "attempted_at")
    found = fr.politeness_audit(log, PROFILE, "event_id", F.lit(AUDIT_GAP_SEC))
    return found.select(
        "event_id",
        "host",
        naive("attempted_at").alias("attempted_at"),
        naive("previous_at").alias("previous_at"),
        "elapsed_us",
    )


def _state_view(frame: DataFrame) -> DataFrame:
    return frame.select(
        "url", "status", "attempt_count", naive("next_fetch_at").alias("next_fetch_at"), "last_error"
    )


def frontier_state(spark, folder):
    attempts = corpus.event_attempts(table(spark, folder, "events"), _event_key())
    return _state_view(fr.fold_attempts(attempts, PROFILE, "event_id"))


def attempt_rows(spark, folder):
    results = corpus.event_results(table(spark, folder, "events"), _event_key())
    rows = fr.attempt_rows(results)
    return rows.withColumn("attempted_at", naive("attempted_at"))


def robots_blocked(spark, folder):
    """The attempt log when results that robots rules forbid fail."""
    rows = fr.attempt_rows(fr.block_disallowed(corpus.page_results(_pages(spark, folder)), PROFILE))
    return rows.withColumn("attempted_at", naive("attempted_at"))


def page_budget(spark, folder):
    """Documents in order until the budget of stored ones is used; copies are free."""
    hashed = _hashed_documents(spark, folder)
    first = dedup.first_contents(hashed, ["doc_id"]).select("doc_id", F.lit("page").alias("outcome"))
    outcomes = hashed.select("doc_id").join(first, "doc_id", "left").fillna("duplicate", ["outcome"])
    return fr.within_budget(outcomes, ["doc_id"], F.col("outcome") == "page", PAGE_BUDGET)


def _queued(results: DataFrame) -> CrawlTables:
    """Start tables whose frontier holds every URL of the results as a seed."""
    spark = results.sparkSession
    start = empty_tables(spark)
    added, queued = dedup.load_seeds(results, start.urls, F.col("fetched_at"), PROFILE)
    return CrawlTables(added, queued, start.pages, start.links, start.fetch_attempts)


def apply_results_outcomes(spark, folder):
    results = corpus.document_results(corpus.spread(table(spark, folder, "documents")))
    return apply_results(results, _queued(results), PROFILE).outcomes.select(
        "url", "status", "outcome", naive("decided_at").alias("decided_at")
    )


def _applied_pages(spark, folder) -> CrawlTables:
    """What a batch of all pages adds when every fetch of a URL with a 7 in it fails."""
    results = corpus.page_results(corpus.spread(_pages(spark, folder)))
    failed = urls.normalize_url(F.col("url"), PROFILE).contains("7")
    content = ["http_status", "content_type", "content_length", "html", "is_html"]
    results = results.withColumns(
        {"error": F.when(failed, "network failure"), **{c: F.when(~failed, F.col(c)) for c in content}}
    )
    return apply_results(results, _queued(results), PROFILE).added


def snapshot_frontier(spark, folder):
    """A stored snapshot of the start tables, updated in place by the batch of all pages (only
    the changed parts rewritten); its frontier read back."""
    results = corpus.page_results(_pages(spark, folder))
    failed = urls.normalize_url(F.col("url"), PROFILE).contains("7")
    content = ["http_status", "content_type", "content_length", "html", "is_html"]
    results = results.withColumns(
        {"error": F.when(failed, "network failure"), **{c: F.when(~failed, F.col(c)) for c in content}}
    )
    root = scratch_path(spark, "snapshot")
    start = _queued(results)
    write_tables(start, root)
    snapshot = read_tables(spark, root)
    added = apply_results(results, snapshot, PROFILE).added
    update_tables(spark, root, added, 0)
    return _frontier_view(read_tables(spark, root).frontier)


def applied_links(spark, folder):
    return _applied_pages(spark, folder).links.select(*_LINK_COLUMNS)


def applied_urls(spark, folder):
    return _applied_pages(spark, folder).urls.withColumn("discovered_at", naive("discovered_at"))


def applied_frontier(spark, folder):
    return _frontier_view(_applied_pages(spark, folder).frontier)


def applied_attempts(spark, folder):
    rows = _applied_pages(spark, folder).fetch_attempts
    return rows.withColumn("attempted_at", naive("attempted_at"))


# Streams


def _streamed_store(spark: SparkSession, folder: str) -> str:
    """A store that pages were streamed into over several micro-batches, one stream restart per
    slice of fetch time; its folder."""
    pages = _pages(spark, folder)
    root, source = scratch_path(spark, "store"), scratch_path(spark, "arriving-pages")
    checkpoint = scratch_path(spark, "checkpoint")
    store.create_store(spark, root, _queued(corpus.page_results(pages)), PROFILE)

    def run() -> None:
        arriving = spark.readStream.schema(pages.schema).parquet(source)
        store.start_ingest(corpus.page_results(arriving), root, checkpoint, PROFILE).awaitTermination()

    replay.replay(pages, F.col("page_id"), source, run)
    return root


def stream_ingest(spark, folder):
    """Pages streamed into a store over several micro-batches; the stored pages."""
    stored = store.read_store(spark, _streamed_store(spark, folder)).pages
    return stored.withColumn("fetched_at", naive("fetched_at"))


def stream_report(spark, folder):
    """The link report of a stream, summed from the counts each micro-batch wrote."""
    return store.read_report(spark, _streamed_store(spark, folder))


def stream_frontier_state(spark, folder):
    """Retry states kept in the stream's state store over several micro-batches (one restart per
    slice of event time); the latest state of each URL."""
    events = table(spark, folder, "events")
    root, source = scratch_path(spark, "states"), scratch_path(spark, "arriving-events")
    checkpoint = scratch_path(spark, "checkpoint")

    def run() -> None:
        arriving = spark.readStream.schema(events.schema).parquet(source)
        attempts = corpus.event_attempts(arriving, _event_key())
        changes = states.stream_states(attempts, PROFILE, "event_id")
        states.write_states(changes, root, checkpoint).awaitTermination()

    replay.replay(events, F.unix_micros(F.col("ts").cast("timestamp")), source, run)
    return _state_view(states.read_states(spark, root))


# Report


def _report(build, *args):
    return lambda spark, folder: build(corpus.crawl_tables(spark, folder), *args)


def crawl_report(spark, folder):
    """All sections. Links and frontier serve several sections, so they are written once."""
    tables = corpus.crawl_tables(spark, folder)
    tables = replace(
        tables, links=stage(tables.links, "links"), frontier=stage(tables.frontier, "frontier")
    )
    return report.crawl_report(tables, PROFILE)


QUERIES = {
    "raw_pages": raw_pages,
    "seed_urls": seed_urls,
    "list_seeds": list_seeds,
    "snapshot_frontier": snapshot_frontier,
    "normalize_url": normalize_url,
    "url_parts": url_parts,
    "url_internal": url_internal,
    "crawlable_urls": crawlable_urls,
    "robots_allowed": robots_allowed,
    "page_kind": page_kind,
    "invalid_urls": invalid_urls,
    "resolve_links": resolve_links,
    "content_hash": content_hash,
    "attempt_errors": attempt_errors,
    "page_titles": page_titles,
    "page_text": page_text,
    "page_links": page_links,
    "page_descriptions": page_descriptions,
    "mixed_links": mixed_links,
    "rejected_links": links_rejected,
    "upsert_urls": upsert_urls,
    "dedup_content": dedup_content,
    "page_rows": page_rows,
    "load_seeds": load_seeds,
    "expand_frontier": expand_frontier,
    "link_graph": link_graph,
    "bfs_depth": bfs_depth,
    "bfs_pruned": bfs_pruned,
    "discovery_tree": discovery_tree,
    "next_batch": next_batch,
    "next_batch_again": next_batch_again,
    "politeness_slots": politeness_slots,
    "politeness_audit": politeness_audit,
    "frontier_state": frontier_state,
    "attempt_rows": attempt_rows,
    "robots_blocked": robots_blocked,
    "page_budget": page_budget,
    "apply_results": apply_results_outcomes,
    "applied_links": applied_links,
    "applied_urls": applied_urls,
    "applied_frontier": applied_frontier,
    "applied_attempts": applied_attempts,
    "stream_ingest": stream_ingest,
    "stream_frontier_state": stream_frontier_state,
    "hub_count": _report(report.hub_count, PROFILE),
    "article_count": _report(report.article_count, PROFILE),
    "page_total": _report(report.page_total),
    "links_by_type": _report(report.links_by_type, PROFILE),
    "frontier_status": _report(report.frontier_status),
    "top_external_hosts": _report(report.top_external_hosts, PROFILE),
    "top_anchors": _report(report.top_anchors, PROFILE),
    "http_status_hist": _report(report.http_status_hist),
    "depth_status": _report(report.depth_status),
    "top_linking_titles": _report(report.top_linking_titles, PROFILE),
    "crawl_report": crawl_report,
    "stream_report": stream_report,
}
