"""Joins against a side whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Above either bound nothing is broadcast and the join shuffles.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A side that is nothing but one long takes little room per row.
MAX_BROADCAST_IDS = 4_000_000


def is_small(keys: DataFrame, key: str) -> bool:
    """Whether ``keys`` may be broadcast, by the bytes of all its columns. It is counted here, so
    it should be staged."""
    if keys.columns == [key] and keys.schema[key].dataType.simpleString() == "bigint":
        return keys.count() <= MAX_BROADCAST_IDS
    text = F.concat_ws("", *[F.col(c).cast("string") for c in keys.columns])
    size = F.sum(F.octet_length(text))
    rows, all_bytes = keys.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return rows <= MAX_BROADCAST_ROWS and all_bytes <= MAX_BROADCAST_BYTES


def broadcast_if_small(side: DataFrame, key: str) -> DataFrame:
    """``side`` marked for broadcast if its size allows; a plain shuffle join otherwise."""
    return F.broadcast(side) if is_small(side, key) else side


def near(history: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of a large table that can match ``keys``, found without shuffling it.

    Keys small enough are broadcast as they are. Above that bound their 64-bit hashes (8 bytes
    a key, up to ``MAX_BROADCAST_IDS``) are broadcast instead: a prefilter that drops almost all
    rows of other keys before the exact semi-join shuffles what is left. Beyond that too the
    semi-join shuffles both sides, so rows of other keys are still dropped before anything after it.
    """
    wanted = keys.select(key).distinct()
    if is_small(wanted, key):
        return history.join(F.broadcast(wanted), key, "left_semi")
    hashes = wanted.select(F.xxhash64(key).alias("_h")).distinct()
    if hashes.count() <= MAX_BROADCAST_IDS:
        history = history.join(F.broadcast(hashes), F.xxhash64(history[key]) == hashes["_h"], "left_semi")
    return history.join(wanted, key, "left_semi")
