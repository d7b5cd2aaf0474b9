"""Time the headline queries and print one JSON line.

Each query is run to a full result (every column of every row is computed) once, after a
warm-up query that starts the JVM and the Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from linkloom.plans.catalogue import QUERIES

HEADLINE = [
    "normalize_url", "page_titles", "page_text", "page_links", "content_hash", "upsert_urls",
    "dedup_content", "page_rows", "expand_frontier", "link_graph", "bfs_depth", "discovery_tree",
    "next_batch", "politeness_slots", "politeness_audit", "frontier_state", "attempt_rows",
    "page_budget", "apply_results", "stream_ingest", "stream_frontier_state", "links_by_type",
    "top_external_hosts", "top_anchors", "top_linking_titles", "crawl_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linkloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["page_titles"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
