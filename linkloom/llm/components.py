"""Connected components by alternating large-star and small-star steps.

Each round hangs every node below the smallest node it can see; a hot node is one key of a
partial aggregation and of a join that Spark may split. Rounds are written to the shared scratch
folder, so no lineage grows and a lost executor costs one round. Edges stay distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.scratch import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v); a component is its smallest node."""
    now = stage(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "stars")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
