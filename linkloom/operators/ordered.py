"""Running totals and look-back over one long order, without one long task.

A window ``partitionBy(host)`` puts a host that holds a third of all rows into one
task, and a window without keys puts everything there. Here the rows are cut into
slices of about equal size by range partitioning on (keys, order), each slice is
worked on alone, and what a slice needs from the slices before it is carried over
from a table of slice ends. A key spans k slices only if k - 1 slice borders lie
inside it, so the carried table has fewer rows than there are slices and its
broadcast is bounded by ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom.scratch import stage

_SLICE = "_slice"


def _sliced(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with a slice number that grows along (keys, order).

    Written out, because the slice number must be the same for every reader.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *keys, *order)
    return stage(ranged.withColumn(_SLICE, F.spark_partition_id()), "sliced")


def _join_carried(sliced: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    return sliced.join(F.broadcast(carried), [_SLICE, *keys], "left")


def running_total(
    df: DataFrame, keys: list[str], order: list[str], value: Column, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the same keys.

    ``order`` must be a total order within the keys; key columns must not be null.
    """
    sliced = _sliced(df.withColumn("_value", value.cast("long")), keys, order)
    within = W.partitionBy(_SLICE, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    before = W.partitionBy(*keys).orderBy(_SLICE).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(_SLICE, *keys)
        .agg(F.sum("_value").alias("_sum"))
        .withColumn("_carried", F.sum("_sum").over(before))
        .filter(F.col("_carried").isNotNull())
        .select(_SLICE, *keys, "_carried")
    )
    total = F.coalesce(F.sum("_value").over(within), F.lit(0)) + F.coalesce("_carried", F.lit(0))
    return _join_carried(sliced, carried, keys).withColumn(name, total).select(*df.columns, name)


def previous_value(
    df: DataFrame, keys: list[str], order: list[str], value: str, name: str
) -> DataFrame:
    """Add ``name``: ``value`` of the row before, within the same keys (null for the first).

    ``order`` must be a total order within the keys; key columns must not be null.
    """
    sliced = _sliced(df, keys, order)
    within = W.partitionBy(_SLICE, *keys).orderBy(*order)
    last = F.max(F.struct(*order, F.col(value).alias("_last")))["_last"]
    carried = (
        sliced.groupBy(_SLICE, *keys)
        .agg(last.alias("_last"))
        .withColumn("_carried", F.lag("_last").over(W.partitionBy(*keys).orderBy(_SLICE)))
        .filter(F.col("_carried").isNotNull())
        .select(_SLICE, *keys, "_carried")
    )
    found = F.when(F.row_number().over(within) > 1, F.lag(value).over(within)).otherwise(
        F.col("_carried")
    )
    return _join_carried(sliced, carried, keys).withColumn(name, found).select(*df.columns, name)
