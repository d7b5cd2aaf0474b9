"""Streaming ingest: the five tables grow by one directory per micro-batch.

A batch reads only what earlier batches committed and overwrites its own directories,
so a replayed batch gives the same result. Its rows become visible, all at once, when
its commit mark is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from linkloom import schemas
from linkloom.operators.ingest import apply_results
from linkloom.operators.lookup import near
from linkloom.profile import SiteProfile
from linkloom.scratch import scratch_scope
from linkloom.sources.tables import CrawlTables
from linkloom.streaming import live_report

_BATCH = "batch_id"
_START = -1


def stream_results(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Raw fetch results as they arrive in a directory."""
    reader = spark.readStream.schema(schemas.RAW).format(fmt).options(**options)
    return reader.load(path)


def _write_batch(
    root: str, batch_id: int, tables: CrawlTables, spark: SparkSession, counts: DataFrame
) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/{_BATCH}={batch_id}")
    counts.write.mode("overwrite").parquet(f"{root}/report/{_BATCH}={batch_id}")
    mark = spark.range(1, numPartitions=1)
    mark.write.mode("overwrite").parquet(f"{root}/commits/{_BATCH}={batch_id}")


def create_store(
    spark: SparkSession, root: str, start: CrawlTables, profile: SiteProfile
) -> None:
    """Write the tables a stream starts from (for instance loaded seeds)."""
    _write_batch(root, _START, start, spark, live_report.counts(start, None, profile))


def read_report(spark: SparkSession, root: str) -> DataFrame:
    """The link report from the counts of all committed batches (``live_report``)."""
    marks = spark.read.parquet(f"{root}/commits").agg(F.max(_BATCH)).first()[0]
    counts = spark.read.schema(f"{live_report.COUNTS}, {_BATCH} bigint").parquet(f"{root}/report")
    return live_report.report(counts.filter(F.col(_BATCH) <= marks).drop(_BATCH))


def latest_rows(history: DataFrame) -> DataFrame:
    """Of the frontier rows that batches wrote, the last one of each URL."""
    values = [c for c in schemas.FRONTIER.fieldNames() if c != "url"]
    latest = F.max_by(F.struct(*values), _BATCH).alias("row")
    return history.groupBy("url").agg(latest).select("url", "row.*")


def read_store(
    spark: SparkSession, root: str, before: int | None = None, history: bool = False
) -> CrawlTables:
    """The committed tables; with ``before``, only what earlier batches committed.

    With ``history`` the frontier has all its rows and their batch, for ``latest_rows`` to be
    applied after a lookup: then other rows are neither shuffled nor sorted.
    """
    # One row per committed batch.
    marks = spark.read.parquet(f"{root}/commits").agg(F.max(_BATCH)).first()[0]
    last = marks if before is None else min(marks, before - 1)
    frames = {}
    for name, schema in schemas.TABLES.items():
        partitioned = T.StructType([*schema, T.StructField(_BATCH, T.LongType())])
        rows = spark.read.schema(partitioned).parquet(f"{root}/{name}")
        frames[name] = rows.filter(F.col(_BATCH) <= last)
    frontier = frames.pop("frontier")
    return CrawlTables(
        frontier=frontier if history else latest_rows(frontier),
        **{name: df.drop(_BATCH) for name, df in frames.items()},
    )


def batch_writer(
    root: str, profile: SiteProfile, enforce_robots: bool = False
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that applies one micro-batch to the store."""

    def write(results: DataFrame, batch_id: int) -> None:
        spark = results.sparkSession
        with scratch_scope(spark, "micro-batch"):
            tables = read_store(spark, root, before=batch_id, history=True)
            applied = apply_results(results, tables, profile, enforce_robots, latest_rows)
            added = applied.added
            replaced = latest_rows(near(tables.frontier, added.frontier.select("url"), "url"))
            counts = live_report.counts(added, replaced, profile)
            _write_batch(root, batch_id, added, spark, counts)

    return write


def start_ingest(
    results: DataFrame,
    root: str,
    checkpoint: str,
    profile: SiteProfile,
    enforce_robots: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Apply a stream of fetch results to the store (default: all that is there, then stop)."""
    return (
        results.writeStream.foreachBatch(batch_writer(root, profile, enforce_robots))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
