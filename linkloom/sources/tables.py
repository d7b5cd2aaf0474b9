"""Sources and sinks: raw fetch results, generated seeds and the five tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import text
from linkloom.profile import SiteProfile


@dataclass(frozen=True)
class CrawlTables:
    """The five tables of a crawl."""

    urls: DataFrame
    frontier: DataFrame
    pages: DataFrame
    links: DataFrame
    fetch_attempts: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in schemas.TABLES]

    def register_views(self) -> None:
        """Make the tables available to ``spark.sql`` under their own names."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)


def empty_tables(spark: SparkSession) -> CrawlTables:
    return CrawlTables(**{n: spark.createDataFrame([], s) for n, s in schemas.TABLES.items()})


def read_results(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Raw fetch results with the declared schema (parquet, json, orc, ...)."""
    return spark.read.schema(schemas.RAW).format(fmt).load(path)


def results_from_bodies(
    bodies: DataFrame, url: str, html: str, fetched_at, content_type, http_status=200
) -> DataFrame:
    """Shape already fetched bodies as raw fetch results."""
    shaped = bodies.select(
        F.col(url).alias("url"),
        F.col(url).alias("final_url"),
        F.lit(http_status).cast("int").alias("http_status"),
        content_type.alias("content_type"),
        F.octet_length(html).cast("long").alias("content_length"),
        F.col(html).alias("html"),
        F.lit(None).cast("int").alias("response_time_ms"),
        text.is_html_type(content_type).alias("is_html"),
        F.lit(None).cast("string").alias("error"),
        fetched_at.alias("fetched_at"),
    )
    return shaped.select(*schemas.RAW.fieldNames())


def seed_urls(spark: SparkSession, profile: SiteProfile) -> DataFrame:
    """The list pages a crawl of the profile's site starts from."""
    head, tail = profile.seed_template.format(host=profile.host_suffix, page="\0").split("\0")
    pages = spark.range(profile.seed_first_page, profile.seed_last_page + 1)
    return pages.select(F.concat(F.lit(head), F.col("id").cast("string"), F.lit(tail)).alias("url"))


#: Partition column of the tables that only grow: the batch that added the rows.
BATCH = "batch_id"
START_BATCH = -1


def write_tables(tables: CrawlTables, root: str) -> None:
    """A new snapshot of all five tables under ``root``, which must not exist yet.

    The frontier is split by status, so picking the next batch reads queued rows only, and an
    update rewrites only the statuses it changes. The other tables are split by the batch that
    added their rows (``START_BATCH`` here), so an update adds a folder of its own.
    """
    for name, df in tables.items():
        if name == "frontier":
            writer = df.write.mode("errorifexists").partitionBy("status")
        else:
            writer = df.withColumn(BATCH, F.lit(START_BATCH)).write.mode("errorifexists").partitionBy(BATCH)
        writer.parquet(f"{root}/{name}")


def update_tables(spark: SparkSession, root: str, added: CrawlTables, batch_id: int) -> None:
    """Apply one batch's ``added`` rows (as ``apply_results`` gives them) to the snapshot in place.

    Growing tables get the folder ``batch_id=<batch_id>``, overwritten if it exists, so a batch
    that is run again after a failure writes the same rows once. Frontier rows of ``added``
    replace rows of the same URL: only the status folders that lose or gain a row are rewritten
    (dynamic partition overwrite), from a copy staged first, since a job cannot overwrite what it
    reads. A status folder left without rows is deleted. Running the same batch again gives the
    same snapshot.
    """
    from linkloom.scratch import remove, stage

    dynamic = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}
    before = {k: spark.conf.get(k, None) for k in dynamic}
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for name, df in added.items():
            if name != "frontier":
                rows = df.select(*schemas.TABLES[name].fieldNames()).withColumn(BATCH, F.lit(batch_id))
                rows.write.mode("overwrite").partitionBy(BATCH).parquet(f"{root}/{name}")
        changed = stage(added.frontier.select(*schemas.FRONTIER.fieldNames()), "changed-frontier")
        current = spark.read.schema(schemas.FRONTIER).parquet(f"{root}/frontier")
        moved_from = current.join(changed.select("url"), "url", "left_semi").select("status")
        statuses = [r.status for r in moved_from.union(changed.select("status")).distinct().collect()]
        kept = current.filter(F.col("status").isin(statuses)).join(changed.select("url"), "url", "left_anti")
        rewritten = stage(kept.unionByName(changed), "frontier-parts")
        rewritten.write.mode("overwrite").partitionBy("status").parquet(f"{root}/frontier")
        filled = {r.status for r in rewritten.select("status").distinct().collect()}
        for status in set(statuses) - filled:
            remove(spark, f"{root}/frontier/status={status}")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_tables(spark: SparkSession, root: str) -> CrawlTables:
    frames = {}
    for name, schema in schemas.TABLES.items():
        frames[name] = (
            spark.read.schema(schema).parquet(f"{root}/{name}").select(*schema.fieldNames())
        )
    return CrawlTables(**frames)
