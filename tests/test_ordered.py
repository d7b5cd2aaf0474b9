"""Order-dependent operators against plain loops, with one key holding most rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linkloom.operators import frontier as fr
from linkloom.operators.ordered import previous_value, running_total

NOW = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    return [
        (i, "hot" if rng.random() < 0.5 else f"k{rng.randrange(60)}", rng.randrange(500), rng.randrange(3))
        for i in range(4000)
    ]


def test_running_total(spark, rows):
    df = spark.createDataFrame(rows, "id int, k string, t int, v int")
    for keys in (["k"], []):
        got = running_total(df, keys, ["t", "id"], F.col("v"), "before").collect()
        totals, want = defaultdict(int), {}
        for i, k, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
            group = k if keys else ""
            want[i] = totals[group]
            totals[group] += v
        assert {r.id: r.before for r in got} == want


def test_previous_value(spark, rows):
    df = spark.createDataFrame(rows, "id int, k string, t int, v int")
    got = previous_value(df, ["k"], ["t", "id"], "t", "prev").collect()
    last, want = {}, {}
    for i, k, t, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = last.get(k)
        last[k] = t
    assert {r.id: r.prev for r in got} == want


def test_politeness_slots(spark, profile):
    rows = [
        ("http://a/2/", "a", 100, 1), ("http://a/1/", "a", 100, 1), ("http://a/9/", "a", 10, 0),
        ("http://x.portal.test/1/", "x.portal.test", 5, 0), ("http://x.portal.test/2/", "x.portal.test", 5, 0),
        ("nohost/", None, 1, 0),
    ]
    df = spark.createDataFrame(rows, "url string, host string, priority int, depth int")
    got = {r.url: (r.slot, r.offset_sec) for r in fr.politeness_slots(df, profile).collect()}
    assert got == {
        "http://a/9/": (0, 0), "http://a/1/": (1, 3), "http://a/2/": (2, 6), "nohost/": (0, 0),
        "http://x.portal.test/1/": (0, 0), "http://x.portal.test/2/": (1, 10),
    }


def test_politeness_audit(spark, profile):
    # One second after the first fetch of the site is nine seconds too early.
    times = [("portal.test", 0, 1), ("portal.test", 1, 2), ("portal.test", 11, 3), ("b", 0, 4), ("b", 2, 5), ("b", 5, 6)]
    df = spark.createDataFrame(
        [(h, NOW + timedelta(seconds=s), i) for h, s, i in times], "host string, attempted_at timestamp, id int"
    )
    got = {r.id: r.elapsed_us for r in fr.politeness_audit(df, profile, "id").collect()}
    assert got == {2: 1_000_000, 5: 2_000_000}


def test_budget(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["page", "duplicate", "error"])) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, outcome string")
    for budget in (0, 1, 57, 10_000):
        used, want = 0, set()
        for i, outcome in rows:
            if used >= budget:
                break
            want.add(i)
            used += outcome == "page"
        got = fr.within_budget(df, ["id"], F.col("outcome") == "page", budget)
        assert {r.id for r in got.collect()} == want
