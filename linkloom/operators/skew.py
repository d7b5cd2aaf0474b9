"""Equi-joins whose hot keys are split over several tasks instead of landing in one.

A key is hot when the left side holds more than ``HOT_ROWS`` rows of it. Counting keys is a
partial aggregate (one row per key and task before the shuffle), and there are at most
rows / HOT_ROWS hot keys, so their table is small; its size is still checked before it is
broadcast. Left rows of a hot key are dealt over ``SPREAD`` salts by a hash of other columns;
right rows of a hot key are repeated once per salt. Other keys keep salt 0 and are not repeated,
so the right side grows by at most SPREAD rows per hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.lookup import broadcast_if_small

HOT_ROWS = 100_000
SPREAD = 32


def hot_keys(left: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, _hot): the keys that ``left`` holds more than ``hot_rows`` times."""
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(key, F.lit(True).alias("_hot"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Sequence[str],
    hot: DataFrame,
    how: str = "inner",
    spread: int = SPREAD,
) -> DataFrame:
    """``left.join(right, key, how)`` (inner or left) with the ``hot`` keys split over ``spread``
    salts; ``spread_by`` are left columns that deal a hot key's rows."""
    marks = broadcast_if_small(hot, key)
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(spread))).otherwise(F.lit(0))
    dealt = left.join(marks, key, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(marks, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")
