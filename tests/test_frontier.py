import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linkloom.operators import frontier as fr

NOW = datetime(2024, 1, 1)
ATTEMPTS = "url string, id int, attempted_at timestamp, success boolean, error_message string"


def fold_in_python(rows, max_attempts=3, start=None):
    """The retry rule as a loop: (url, id, time, success, message) -> url -> state."""
    state = dict(start or {})
    for url, _, at, ok, message in sorted(rows, key=lambda r: (r[2], r[1])):
        status, failures, due, error = state.get(url, ("queued", 0, None, None))
        if status not in ("queued", "fetching"):
            continue
        if ok:
            status = "done"
        elif failures >= max_attempts - 1:
            status, error, failures = "failed", message, failures + 1
        else:
            status, due, failures = "queued", at + timedelta(seconds=5 * 3**failures), failures + 1
        state[url] = (status, failures, due, error)
    return state


def states(df):
    return {r.url: (r.status, r.attempt_count, r.next_fetch_at, r.last_error) for r in df.collect()}


@pytest.mark.parametrize("failures,expected", [
    (1, ("queued", 1, NOW + timedelta(seconds=5), None)),
    (2, ("queued", 2, NOW + timedelta(hours=1, seconds=15), None)),
    (3, ("failed", 3, NOW + timedelta(hours=1, seconds=15), "boom3")),
    (4, ("failed", 3, NOW + timedelta(hours=1, seconds=15), "boom3")),
])
def test_retry_ladder(spark, profile, failures, expected):
    rows = [("u", i, NOW + timedelta(hours=i), False, f"boom{i + 1}") for i in range(failures)]
    got = states(fr.fold_attempts(spark.createDataFrame(rows, ATTEMPTS), profile, "id"))
    assert got == {"u": expected}


def test_success_leaves_retry_fields_as_they_were(spark, profile):
    rows = [("u", 0, NOW, False, "boom"), ("u", 1, NOW, True, None), ("u", 2, NOW, False, "late")]
    got = states(fr.fold_attempts(spark.createDataFrame(rows, ATTEMPTS), profile, "id"))
    assert got == {"u": ("done", 1, NOW + timedelta(seconds=5), None)}


def random_attempts(n=3000, seed=2):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else f"u{rng.randrange(900)}", i,
         NOW + timedelta(seconds=rng.randrange(100)), rng.random() < 0.3, f"m{i}")
        for i in range(n)
    ]


def test_fold_equals_loop(spark, profile):
    rows = random_attempts()
    got = states(fr.fold_attempts(spark.createDataFrame(rows, ATTEMPTS), profile, "id"))
    assert got == fold_in_python(rows)


def test_fold_continues_from_the_frontier(spark, profile):
    rows = random_attempts(seed=4)
    rng = random.Random(9)
    start = {
        u: ("queued", rng.randrange(3), NOW - timedelta(days=1), None) for u in sorted({r[0] for r in rows})
    }
    before = spark.createDataFrame(
        [(u, n, due) for u, (_, n, due, _) in start.items()], "url string, attempt_count int, next_fetch_at timestamp"
    )
    df = spark.createDataFrame(rows, ATTEMPTS).join(before, "url")
    assert states(fr.fold_attempts(df, profile, "id")) == fold_in_python(rows, start=start)


def _frontier(spark, rows):
    return spark.createDataFrame(rows, "url string, status string, priority int, depth int, next_fetch_at timestamp")


def test_next_batch_order_and_due_time(spark):
    frontier = _frontier(spark, [
        ("a", "queued", 20, 1, NOW), ("b", "queued", 10, 0, NOW), ("c", "queued", 10, 0, NOW + timedelta(hours=1)),
        ("d", "done", 1, 0, NOW), ("e", "queued", 10, 1, NOW),
    ])
    table = spark.createDataFrame([(u, "h") for u in "abcde"], "url string, host string")
    got = fr.next_batch(frontier, table, F.lit(NOW), 2).collect()
    assert {(r.url, r.host, r.status) for r in got} == {("b", "h", "fetching"), ("e", "h", "fetching")}
    later = fr.next_batch(_frontier(spark, [("c", "queued", 1, 0, NOW + timedelta(hours=1))]), table, F.lit(NOW), 1)
    assert later.collect() == []


def test_attempt_rows(spark):
    rows = [("a", NOW, None, 200, 7), ("b", NOW, "request timed out", None, None), ("c", NOW, "boom", None, None), ("d", NOW, "", None, None)]
    df = spark.createDataFrame(rows, "url string, fetched_at timestamp, error string, http_status int, response_time_ms int")
    got = {r.url: (r.success, r.error_type, r.error_message) for r in fr.attempt_rows(df).collect()}
    assert got == {
        "a": (True, None, None), "b": (False, "timeout", "request timed out"),
        "c": (False, "request_error", "boom"), "d": (False, None, ""),
    }


def test_replace_rows(spark):
    table = spark.createDataFrame([("a", 1), ("b", 1)], "url string, v int")
    changes = spark.createDataFrame([("b", 2), ("c", 2)], "url string, v int")
    assert sorted(map(tuple, fr.replace_rows(table, changes).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_large_batch_equals_small_one(spark, monkeypatch):
    rows = [(f"u{i}", "queued", i % 3, i % 2, NOW) for i in range(200)]
    table = spark.createDataFrame([(r[0], "h") for r in rows], "url string, host string")
    small = fr.next_batch(_frontier(spark, rows), table, F.lit(NOW), 70).collect()
    monkeypatch.setattr(fr, "SMALL_BATCH", 10)
    large = fr.next_batch(_frontier(spark, rows), table, F.lit(NOW), 70).collect()
    assert len(large) == 70 and sorted(map(str, large)) == sorted(map(str, small))
