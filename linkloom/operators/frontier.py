"""Frontier as a table: next batch, politeness, attempt log, retries, budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.functions import text, urls
from linkloom.operators.ordered import previous_value, running_total
from linkloom.profile import SiteProfile
from linkloom.scratch import stage

# Up to this many rows a batch is merged in one task and broadcast.
SMALL_BATCH = 100_000


def next_batch(frontier: DataFrame, urls_table: DataFrame, at: Column, size: int) -> DataFrame:
    """The ``size`` best queued rows that are due at ``at``, with host, marked ``fetching``.

    Best is lowest priority number, then lowest depth, then URL. Each task keeps only its
    own best rows. Every frontier row has a urls row, so the join follows the limit and
    neither table is shuffled. A batch of more than ``SMALL_BATCH`` rows is taken from
    range-partitioned slices instead, and joined by a shuffle.
    """
    order = ["priority", "depth", "url"]
    due = frontier.filter((F.col("status") == "queued") & (F.col("next_fetch_at") <= at))
    if size <= SMALL_BATCH:
        picked = F.broadcast(due.orderBy(*order).limit(size))
    else:
        placed = running_total(due, [], order, F.lit(1), "_place")
        picked = placed.filter(F.col("_place") < size).drop("_place")
    picked = picked.withColumn("status", F.lit("fetching"))
    return urls_table.select("url", "host").join(picked, "url")


def mark_fetching(frontier: DataFrame, picked: DataFrame) -> DataFrame:
    """The frontier snapshot after a batch was handed out, so the next pick skips it."""
    return replace_rows(frontier, picked.select(*schemas.FRONTIER.fieldNames()))


def politeness_slots(candidates: DataFrame, profile: SiteProfile) -> DataFrame:
    """Earliest fetch offset in seconds of each candidate (url, host, priority, depth).

    Rows of one host are spaced by the host's gap. Rows without a host need no pause.
    The candidates are written once, so both parts read them instead of computing them again.
    """
    candidates = stage(candidates, "candidates")
    hosted = candidates.filter(F.col("host").isNotNull())
    slots = running_total(hosted, ["host"], ["priority", "depth", "url"], F.lit(1), "slot")
    spaced = slots.withColumn(
        "offset_sec", F.col("slot") * urls.site_gap_seconds(F.col("host"), profile)
    )
    free = candidates.filter(F.col("host").isNull())
    return spaced.unionByName(
        free.withColumn("slot", F.lit(0).cast("long")).withColumn(
            "offset_sec", F.lit(0).cast("long")
        )
    )


def politeness_audit(
    attempts: DataFrame, profile: SiteProfile, tie: str, gap_sec: Column | None = None
) -> DataFrame:
    """Attempts (host, attempted_at, tie) that came too soon after the one before on the host."""
    gap = urls.site_gap_seconds(F.col("host"), profile) if gap_sec is None else gap_sec
    hosted = attempts.filter(F.col("host").isNotNull())
    logged = previous_value(
        hosted, ["host"], ["attempted_at", tie], "attempted_at", "previous_at"
    )
    too_soon = F.col("attempted_at") < F.col("previous_at") + F.make_dt_interval(secs=gap)
    elapsed = F.timestamp_diff("MICROSECOND", F.col("previous_at"), F.col("attempted_at"))
    return logged.filter(too_soon).withColumn("elapsed_us", elapsed)


def attempt_rows(results: DataFrame) -> DataFrame:
    """Rows of the fetch_attempts table: one per result, failed or not."""
    error = F.col("error")
    return results.select(
        "url",
        F.col("fetched_at").alias("attempted_at"),
        text.attempt_success(error).alias("success"),
        "http_status",
        text.error_type(error).alias("error_type"),
        error.alias("error_message"),
        "response_time_ms",
    )


def block_disallowed(results: DataFrame, profile: SiteProfile) -> DataFrame:
    """Turn results for URLs that robots rules forbid into failed ones without content."""
    allowed = urls.is_allowed(F.col("url"), profile)
    blanked = {"http_status", "content_type", "content_length", "html", "response_time_ms", "is_html"}
    return results.select(
        *(
            F.when(allowed, F.col(c)).alias(c)
            if c in blanked
            else F.when(allowed, F.col(c)).otherwise("Blocked by robots.txt").alias(c)
            if c == "error"
            else F.col(c)
            for c in results.columns
        )
    )


def first_attempts(
    attempts: DataFrame, profile: SiteProfile, tie: str, before_tie: Sequence[str] = ()
) -> DataFrame:
    """The attempts that can decide a URL's state: its first ``max_attempts`` in time.

    A URL ends with its first success or its last allowed failure, so later ones never
    matter. The rank filter is applied per task before the shuffle and again after it:
    a URL with very many attempts costs a few rows per task. Attempts of one time are
    ordered by ``before_tie``, then by ``tie``, which names the attempt.
    """
    in_order = W.partitionBy("url").orderBy("attempted_at", *before_tie, tie)
    ranked = attempts.withColumn("_rank", F.row_number().over(in_order))
    return ranked.filter(F.col("_rank") <= profile.max_attempts)


def fold_attempts(
    attempts: DataFrame, profile: SiteProfile, tie: str, before_tie: Sequence[str] = ()
) -> DataFrame:
    """Final state per URL after its attempts, in (time, ``before_tie``, ``tie``) order.

    ``attempts``: url, attempted_at, ``tie``, success, error_message and, optionally,
    what the frontier held before: attempt_count, next_fetch_at, last_error (equal on
    all rows of a URL). The result has url, status, attempt_count, next_fetch_at,
    last_error, updated_at (time of the attempt last used) and last_used (its tie).
    """
    earlier = {"attempt_count": F.lit(0), "next_fetch_at": F.lit(None).cast("timestamp")}
    earlier["last_error"] = F.lit(None).cast("string")
    relevant = first_attempts(attempts, profile, tie, before_tie).select(
        "url",
        "_rank",
        "attempted_at",
        F.col(tie).alias("tie"),
        "success",
        "error_message",
        *(
            (F.col(c) if c in attempts.columns else absent).alias(f"{c}_before")
            for c, absent in earlier.items()
        ),
    )
    per_url = relevant.groupBy("url").agg(
        F.array_sort(
            F.collect_list(F.struct("_rank", "attempted_at", "tie", "success", "error_message"))
        ).alias("log"),
        *(F.first(f"{c}_before").alias(f"{c}_before") for c in earlier),
    )

    log, before = F.col("log"), F.col("attempt_count_before")
    first_success = F.array_position(F.transform("log", lambda a: a["success"]), True)
    failures = F.when(first_success > 0, first_success - 1).otherwise(F.size(log)).cast("int")
    allowed = F.greatest(F.lit(profile.max_attempts) - before, F.lit(1))
    decided = per_url.withColumn("failures", F.least(failures, allowed)).withColumn(
        "status",
        F.when(F.col("failures") >= allowed, "failed")
        .when(first_success > 0, "done")
        .otherwise("queued"),
    )
    # The failure that exhausts the attempts sets no new due time.
    waits = F.col("failures") - F.when(F.col("status") == "failed", 1).otherwise(0)
    last_wait = F.get(log, waits - 1)["attempted_at"]
    used = F.col("failures") + F.when(F.col("status") == "done", 1).otherwise(0)
    last_used = F.get(log, used - 1)
    return decided.select(
        "url",
        "status",
        (before + F.col("failures")).alias("attempt_count"),
        F.when(waits > 0, text.retry_at(last_wait, before + waits - 1, profile))
        .otherwise(F.col("next_fetch_at_before"))
        .alias("next_fetch_at"),
        F.when(F.col("status") == "failed", last_used["error_message"])
        .otherwise(F.col("last_error_before"))
        .alias("last_error"),
        last_used["attempted_at"].alias("updated_at"),
        last_used["tie"].alias("last_used"),
    )


def within_budget(
    outcomes: DataFrame, order: list[str], counted: Column, max_pages: int
) -> DataFrame:
    """The results handled before the page budget is used up, in fetch order.

    ``counted`` marks results that use the budget (stored pages); errors and content
    duplicates are free. Handling stops as soon as ``max_pages`` are counted.
    """
    running = running_total(outcomes, [], order, counted.cast("int"), "_pages_before")
    return running.filter(F.col("_pages_before") < max_pages).drop("_pages_before")


def apply_states(frontier: DataFrame, states: DataFrame) -> DataFrame:
    """The frontier rows that have a folded state, with that state written over them."""
    changed = {"status", "attempt_count", "next_fetch_at", "last_error", "updated_at"}
    kept = frontier.drop(*changed)
    return kept.join(states.select("url", *changed), "url").select(*schemas.FRONTIER.fieldNames())


def replace_rows(table: DataFrame, changes: DataFrame) -> DataFrame:
    """A new snapshot: rows of ``changes`` replace rows of the same URL or are added."""
    return table.join(changes.select("url"), "url", "left_anti").unionByName(changes)
