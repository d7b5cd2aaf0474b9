"""Maps a folder of page, document and event tables onto crawl inputs.

``pages`` (page_id, url, html) are fetched bodies, ``documents`` (doc_id, text, lang,
source) give fetch results with copies, non-HTML bodies and failures, and ``events``
(event_id, ts, user_id, event_type, value) are a log of fetch attempts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import text, urls
from linkloom.operators import dedup, frontier as fr, graph
from linkloom.operators.html import parse_pages
from linkloom.operators.ingest import parse_results
from linkloom.operators.lookup import broadcast_if_small
from linkloom.profile import SiteProfile
from linkloom.scratch import stage
from linkloom.sources.tables import CrawlTables, results_from_bodies

# Rules for the hosts and paths that occur in the tables.
PROFILE = SiteProfile(
    host_suffix="example.com",
    article_likes=("%/en/%", "%/fr/%"),
    hub_likes=("%/de/%",),
    crawl_patterns=(r"/(en|fr)/[0-9]+(\.html)?/", r"/[^/]+/"),
    disallowed_prefixes=("/es/",),
)

_START = "timestamp_ntz'2024-01-01 00:00:00'"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core for costly per-row work when the input has few splits; inputs
    with enough splits stay as they are."""
    return spread_like(df, df)


def spread_like(df: DataFrame, sample: DataFrame) -> DataFrame:
    """``spread`` for a stream, judged by a batch read of the same files."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if sample.rdd.getNumPartitions() < cores else df


def naive(timestamp: str) -> Column:
    return F.col(timestamp).cast("timestamp_ntz")


def seconds_in(seconds: Column) -> Column:
    return (F.expr(_START) + F.make_dt_interval(secs=seconds)).cast("timestamp")


def page_results(pages: DataFrame) -> DataFrame:
    """Pages as raw fetch results, fetched one per second in page_id order. A body that
    breaks off counts as partial content."""
    complete = F.col("html").contains("</html>")
    return results_from_bodies(
        pages,
        "url",
        "html",
        fetched_at=seconds_in(F.col("page_id")),
        content_type=F.lit("text/html; charset=utf-8"),
        http_status=F.when(complete, 200).otherwise(206),
    )


def document_results(documents: DataFrame) -> DataFrame:
    """Documents as raw fetch results of article URLs. German ones are not HTML; the
    source decides how many attempts fail, one attempt per day, before one works
    (three fail: none works)."""
    failures = (
        F.when(F.col("source").isin("src0", "src1"), 1).when(F.col("source") == "src2", 3).otherwise(0)
    )
    attempts = F.sequence(F.lit(0), F.when(F.col("source") == "src0", 0).when(failures == 3, 2).otherwise(failures))
    rows = documents.withColumn("failures", failures).withColumn("attempt", F.explode(attempts))
    failed = F.col("attempt") < F.col("failures")
    escaped = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.concat(F.lit("<html><body><p>"), escaped, F.lit("</p></body></html>"))
    content_type = F.when(F.col("lang") == "de", "text/plain").otherwise("text/html")
    url = F.concat(F.lit("https://www.example.com/en/"), F.col("doc_id").cast("string"))
    return rows.select(
        url.alias("url"),
        url.alias("final_url"),
        F.when(~failed, 200).alias("http_status"),
        F.when(~failed, content_type).alias("content_type"),
        F.when(~failed, F.octet_length(body).cast("long")).alias("content_length"),
        F.when(~failed, body).alias("html"),
        F.lit(None).cast("int").alias("response_time_ms"),
        F.when(~failed, text.is_html_type(content_type)).alias("is_html"),
        F.when(failed, F.lit("network failure")).alias("error"),
        seconds_in(F.col("doc_id") + F.col("attempt") * 86400).alias("fetched_at"),
    )


def event_results(events: DataFrame, url: Column) -> DataFrame:
    """Events as fetch results without content; ``error`` events are failures."""
    kind, failed = F.col("event_type"), F.col("event_type") == "error"
    message = F.when(F.col("event_id") % 2 == 0, "request timed out").otherwise("network failure")
    status = (
        F.when(kind.isin("view", "click"), 200).when(kind == "signup", 301).when(kind == "purchase", 404)
    )
    return events.select(
        "event_id",
        url.alias("url"),
        status.cast("int").alias("http_status"),
        F.col("value").cast("int").alias("response_time_ms"),
        F.when(failed, message).alias("error"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
    )


def event_attempts(events: DataFrame, url: Column) -> DataFrame:
    """The attempt log of ``event_results``, with event_id to break ties."""
    results = event_results(events, url)
    return results.select(
        "event_id",
        "url",
        F.col("fetched_at").alias("attempted_at"),
        text.attempt_success(F.col("error")).alias("success"),
        F.col("error").alias("error_message"),
    )


def parsed_pages(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    """Parsed fields of every page, with the named page columns."""
    return parse_pages(spread(table(spark, folder, "pages")), base="url", keep=list(keep))


def site_root(url: Column) -> Column:
    return F.concat(F.substring_index(url, "/", 3), F.lit("/"))


def site_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges (from_url, to_url) between each page and the root of its site, both ways."""
    url = urls.normalize_url(F.col("url"), PROFILE)
    pages = table(spark, folder, "pages").select(url.alias("url")).distinct()
    up = pages.select(F.col("url").alias("from_url"), site_root(F.col("url")).alias("to_url"))
    return up.unionByName(
        up.select(F.col("to_url").alias("from_url"), F.col("from_url").alias("to_url"))
    )


def stored_pages(spark: SparkSession, folder: str, bodies: bool = True) -> DataFrame:
    """Parsed pages as they would be stored: the first fetch of each canonical URL,
    unless an earlier page has the same text. Without ``bodies``, html and text are null."""
    results = page_results(spread(table(spark, folder, "pages")))
    parsed = parse_results(results, PROFILE, bodies)
    narrow = parsed.select("result_id", "url", "fetched_at", "content_hash")
    fetched = stage(dedup.first_per_key(narrow, "url", ["fetched_at"]), "fetched")
    stored = dedup.first_contents(fetched, ["fetched_at", "url"]).select("result_id")
    kept = broadcast_if_small(stage(stored, "stored"), "result_id")
    return parsed.join(kept, "result_id", "left_semi")


def crawl_tables(spark: SparkSession, folder: str) -> CrawlTables:
    """The five tables after a crawl that started from every page. Page bodies and
    texts are left out: the queries on these tables do not read them."""
    stored = stored_pages(spark, folder, bodies=False)
    results = page_results(table(spark, folder, "pages"))
    pages = dedup.page_rows(stored)
    links = graph.link_rows(stored, PROFILE)
    fetched = results.select(
        urls.normalize_url(F.col("url"), PROFILE).alias("url"), F.col("fetched_at").alias("at")
    )
    seeds = fetched.groupBy("url").agg(F.min("at").alias("at"))
    done = seeds.select(
        *dedup.frontier_rows(
            "url", F.lit(0), F.lit(PROFILE.seed_priority), F.lit(None), F.col("at")
        )
    ).withColumn("status", F.lit("done"))
    offers = links.select(
        F.col("to_url").alias("url"),
        F.col("from_url").alias("discovered_from"),
        F.lit(0).alias("parent_depth"),
        "discovered_at",
    )
    found = links.select(F.col("to_url").alias("url"), "discovered_at").unionByName(
        seeds.withColumnRenamed("at", "discovered_at")
    )
    no_urls = spark.createDataFrame([], schemas.URLS)
    return CrawlTables(
        urls=dedup.new_urls(found, no_urls, PROFILE),
        frontier=done.unionByName(dedup.expand_frontier(offers, done, PROFILE)),
        pages=pages,
        links=links,
        fetch_attempts=fr.attempt_rows(results),
    )
