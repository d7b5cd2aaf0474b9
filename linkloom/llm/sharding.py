"""Global shuffle of records into shards by a two-pass external shuffle.

Pass one scatters the records by a seeded hash into buckets that each fit in memory. Pass two
shuffles each bucket by Fisher and Yates (the built-in ``shuffle``). The buckets one after the
other are then a random order of all records; the place in it, dealt round robin, gives the
shard and the slot, so shard sizes differ by one record at most (law ``rows``).

Built-in functions only. Bucket offsets are sums of counts: within blocks of buckets, then over
the blocks.

Defined cases: null keys and texts are hashed as such; equal rows are each given a slot, which of
them gets which is left open; an empty table gives no rows; all input columns pass through, but
input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SHARDS = 8
SEED = 20_240_607
BUCKET_BYTES = 24 << 20
_BLOCK = 4096
_MAX_BROADCAST_BUCKETS = 1_000_000


def record_size(text: str = "text"):
    """Bytes of a record: those of its text in UTF-8 and one for its end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _bases(counts: DataFrame) -> DataFrame:
    """(bucket, base): the number of records in the buckets before each."""
    blocked = counts.withColumn("_block", F.expr(f"_bucket div {_BLOCK}"))
    before = W.rowsBetween(W.unboundedPreceding, -1)
    blocks = blocked.groupBy("_block").agg(F.sum("_n").alias("_all"))
    blocks = blocks.select(
        "_block", F.coalesce(F.sum("_all").over(before.orderBy("_block")), F.lit(0)).alias("_start")
    )
    within = F.sum("_n").over(before.partitionBy("_block").orderBy("_bucket"))
    return blocked.join(F.broadcast(blocks), "_block").select(
        "_bucket", (F.col("_start") + F.coalesce(within, F.lit(0))).alias("_base")
    )


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard)."""
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    total = docs.agg(F.sum(record_size(text))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    mixed = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    keyed = docs.select(*columns, mixed.alias("_mixed")).withColumn(
        "_bucket", F.pmod("_mixed", F.lit(buckets))
    )
    bases = _bases(keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")))
    if buckets <= _MAX_BROADCAST_BUCKETS:  # one narrow row a bucket
        bases = F.broadcast(bases)
    filled = keyed.groupBy("_bucket").agg(
        F.collect_list(F.struct("_mixed", *columns)).alias("_records")
    )
    dealt = filled.join(bases, "_bucket").select(
        "_base", F.posexplode(F.shuffle(F.sort_array("_records"), seed)).alias("_at", "_record")
    )
    place = F.col("_base") + F.col("_at")
    return dealt.select(
        *[F.col("_record")[c].alias(c) for c in columns],
        F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
        F.floor(place / shards).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, records in slot order in each file."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).mode("overwrite").parquet(path)


def digest(docs: DataFrame) -> DataFrame:
    sharded = shuffle_into_shards(docs.select("doc_id", "text"))
    return sharded.select(
        "doc_id",
        record_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
