"""Let a table arrive in time slices, so that a stream sees it over several micro-batches.

Each slice is appended to the stream's source folder and the stream is then restarted from its
checkpoint with a bounded trigger (``availableNow``): it handles exactly the files that arrived
since its last run, as one micro-batch, and stops. A slice holds all rows of one range of the
ordering column, so rows that are equal in it share a micro-batch and batches arrive in the
column's order; rows where it is null arrive first, as they sort first in a batch fold.

The number of slices grows with the table (``rows_per_batch``), so a micro-batch stays bounded
at any size. The table is read once: it is dealt into a folder per slice, and each slice is copied
from its own folder. Slices are written by many tasks at once; nothing passes through the driver
but the minimum and maximum of the column.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.scratch import remove, scratch_path

#: Rows one micro-batch takes at most on even data; at least ``MIN_SLICES`` slices are made.
ROWS_PER_BATCH = 2_000_000
MIN_SLICES = 3


def slice_bounds(df: DataFrame, order: Column, rows_per_batch: int = ROWS_PER_BATCH) -> list[int]:
    """Upper bounds (exclusive, the last inclusive) of equal-width ranges of ``order`` (a long)."""
    n, lo, hi = df.agg(F.count(F.lit(1)), F.min(order), F.max(order)).first()
    if not n or lo is None:
        return [0]
    slices = max(MIN_SLICES, math.ceil(n / rows_per_batch))
    width = max(1, math.ceil((hi - lo + 1) / slices))
    return [lo + width * (k + 1) for k in range(slices)]


def _slice_of(bounds: list[int]) -> Column:
    """The number of a row's slice; nulls of ``_order`` are in the first."""
    if len(bounds) == 1:
        return F.lit(0)
    width = bounds[1] - bounds[0]
    return F.coalesce(F.expr(f"int((_order - {bounds[0] - width}) div {width})"), F.lit(0))


def replay(
    df: DataFrame,
    order: Column,
    source: str,
    run: Callable[[], None],
    rows_per_batch: int = ROWS_PER_BATCH,
) -> int:
    """Append ``df`` to ``source`` slice by slice, calling ``run`` (one stream restart) after each.

    Returns the number of slices. ``order`` must be a long column (for instance microseconds of a
    time); slices are ranges of it, the first one with the nulls.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_order", order)
    bounds = slice_bounds(keyed, F.col("_order"), rows_per_batch)
    dealt = scratch_path(spark, "slices")
    # Hashes split a slice among tasks, so a slice has few files and no task a whole one.
    keyed.withColumn("_slice", _slice_of(bounds)).drop("_order").repartitionByRange(
        "_slice", F.xxhash64(*df.columns)
    ).write.partitionBy("_slice").parquet(dealt)
    schema = T.StructType([*df.schema, T.StructField("_slice", T.IntegerType())])
    for k in range(len(bounds)):
        rows = spark.read.schema(schema).parquet(dealt).filter(F.col("_slice") == k).drop("_slice")
        rows.write.mode("append").parquet(source)
        run()
    remove(spark, dealt)
    return len(bounds)
