"""Retry state per URL, kept up to date from a stream of fetch attempts.

``start_states`` folds each micro-batch with built-in operations against a table of
states; it is the one to use when a micro-batch touches many URLs. ``stream_states`` keeps
the states in the state store of the stream; it never reads URLs that a batch does not
touch, but calls Python once per URL.

Both take the attempts of one micro-batch in (time, tie) order and micro-batches in
arrival order, and ignore attempts on a URL that has ended. No watermark is set, so no
late attempt is dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import timedelta
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from linkloom.operators.frontier import first_attempts, fold_attempts
from linkloom.operators.lookup import near
from linkloom.profile import SiteProfile
from linkloom.scratch import scratch_scope, stage

_STATE = "status string, attempt_count int, next_fetch_at timestamp, last_error string"
_OUTPUT = f"url string, {_STATE}"
_COLUMNS = ["url", "status", "attempt_count", "next_fetch_at", "last_error"]
_BATCH = "batch_id"
_START = -1
_DECIDING = ["attempted_at", "tie", "success", "error_message"]


def _first_of_each_url(n: int):
    """Per Arrow batch, the first ``n`` attempts of each URL: later ones cannot matter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            order = pc.sort_indices(
                rows,
                sort_keys=[(c, "ascending") for c in ("url", "attempted_at", "tie")],
            )
            rows = rows.take(order)
            rank = rows["url"].to_pandas().groupby(rows["url"].to_pandas()).cumcount()
            yield from rows.filter(pa.array(rank.to_numpy() < n)).to_batches()

    return run


def stream_states(attempts: DataFrame, profile: SiteProfile, tie: str) -> DataFrame:
    """States that change, as a stream; use output mode ``update``.

    Before the shuffle each URL is cut to the attempts that can matter, and inside a
    group only as many are held at a time.
    """
    limit = profile.max_attempts

    def fold(key, chunks: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first: list[tuple] = []
        for chunk in chunks:
            first += zip(*(chunk[c].tolist() for c in _DECIDING))
            first.sort(key=itemgetter(0, 1))
            del first[limit:]
        status, failures, due, error = state.get if state.exists else ("queued", 0, None, None)
        if status != "queued":
            return
        for attempted_at, _, success, message in first:
            if success:
                status = "done"
            elif failures >= limit - 1:
                failures, status, error = failures + 1, "failed", message
            else:
                pause = profile.backoff_base_sec * profile.backoff_factor**failures
                due = (attempted_at + timedelta(seconds=pause)).to_pydatetime()
                failures += 1
            if status != "queued":
                break
        state.update((status, failures, due, error))
        changed = ([key[0]], [status], [failures], np.array([due], "datetime64[ns]"), [error])
        yield pd.DataFrame(dict(zip(_COLUMNS, changed)))  # typed at once: this runs for each URL

    narrow = attempts.select("url", *(F.col(tie).alias(c) if c == "tie" else c for c in _DECIDING))
    deciding = narrow.mapInArrow(_first_of_each_url(limit), narrow.schema)
    return deciding.groupBy("url").applyInPandasWithState(
        fold, _OUTPUT, _STATE, "update", GroupStateTimeout.NoTimeout
    )


def start_states(
    attempts: DataFrame, root: str, checkpoint: str, profile: SiteProfile, tie: str
) -> StreamingQuery:
    """Fold a stream of attempts into the table of states under ``root``.

    A micro-batch writes the states it changes to a directory of its own and reads only
    those of earlier ones, so a replayed batch gives the same result.
    """
    spark = attempts.sparkSession
    nothing = spark.createDataFrame([], _OUTPUT)
    nothing.write.mode("ignore").parquet(f"{root}/{_BATCH}={_START}")

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark, "states"):
            deciding = stage(first_attempts(batch, profile, tie).drop("_rank"), "deciding")
            earlier = read_states(spark, root, batch_id, deciding)
            known = deciding.join(earlier, "url", "left").filter(
                F.coalesce("status", F.lit("queued")) == "queued"
            )
            known = known.withColumn("attempt_count", F.coalesce("attempt_count", F.lit(0)))
            changed = fold_attempts(known, profile, tie).select(*_COLUMNS)
            changed.write.mode("overwrite").parquet(f"{root}/{_BATCH}={batch_id}")

    return _start(attempts.writeStream.foreachBatch(write), checkpoint)


def write_states(states: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Write the changes of ``stream_states`` to one directory per micro-batch."""

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/{_BATCH}={batch_id}")

    return _start(states.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def _start(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_states(
    spark: SparkSession, root: str, before: int | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """The latest state of each URL; with ``before``, as of the earlier micro-batches.

    With ``keys`` only the states of their URLs are needed: the rows are looked up before
    the latest of each is taken, so other rows are neither shuffled nor sorted.
    """
    rows = spark.read.schema(f"{_OUTPUT}, {_BATCH} bigint").parquet(root)
    if before is not None:
        rows = rows.filter(F.col(_BATCH) < before)
    if keys is not None:
        rows = near(rows, keys, "url")
    latest = F.max_by(F.struct(*(c for c in _COLUMNS if c != "url")), _BATCH).alias("row")
    return rows.groupBy("url").agg(latest).select("url", "row.*")
