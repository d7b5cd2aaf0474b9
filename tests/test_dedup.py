import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.operators import dedup
from linkloom.sources import tables as T

NOW = datetime(2024, 1, 1)


def test_new_urls_are_unseen_distinct_and_split(spark, profile):
    known = spark.createDataFrame([("https://portal.test/a/",)], "url string")
    found = spark.createDataFrame(
        [
            ("https://portal.test/a/", NOW),
            ("https://x.portal.test/b/?q=1", NOW + timedelta(1)),
            ("https://x.portal.test/b/?q=1", NOW),
            ("http://other.test:8080/", NOW),
        ],
        "url string, discovered_at timestamp",
    )
    got = dedup.new_urls(found, known, profile)
    assert got.columns == schemas.URLS.fieldNames()
    assert sorted(map(tuple, got.collect())) == [
        ("http://other.test:8080/", "http", "other.test", "/", "", False, NOW),
        ("https://x.portal.test/b/?q=1", "https", "x.portal.test", "/b/", "q=1", True, NOW),
    ]


def test_first_content_wins_and_missing_hash_never_counts_as_copy(spark):
    rng = random.Random(3)
    # A third of all rows share one hash, a third have none.
    rows = [
        (i, rng.choice(["hot", None, f"h{rng.randrange(40)}"]), rng.randrange(20)) for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "id int, content_hash string, at int")
    known = spark.createDataFrame([("h1",), ("h2",), (None,)], "content_hash string")
    seen, want = {"h1", "h2"}, set()
    for i, h, at in sorted(rows, key=lambda r: (r[2], r[0])):
        if h is None or h not in seen:
            want.add(i)
            seen.add(h)
    got = dedup.first_contents(df, ["at", "id"], known)
    assert {r.id for r in got.collect()} == want


def test_copies_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("content_hash"))
    plan = dedup.keep_first(df, "content_hash", ["id"])._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange


def test_page_rows_without_html_have_no_content(spark):
    row = {name: None for name in schemas.PAGES.fieldNames()} | {
        "url": "http://h/f.pdf/", "fetched_at": NOW, "html": "binary-ish", "title": "t",
        "text_content": "x", "content_hash": "h", "is_html": False, "content_length": 10,
    }
    fields = [f for f in schemas.PAGES if f.name != "is_html"]
    schema = type(schemas.PAGES)([*fields, schemas.RAW["is_html"]])
    df = spark.createDataFrame([tuple(row[f.name] for f in schema)], schema)
    got = dedup.page_rows(df).first()
    assert (got.html, got.title, got.text_content, got.content_hash) == (None,) * 4
    assert (got.is_html, got.content_length) == (False, 10)


def test_seeds_load_once(spark, profile):
    seeds = T.seed_urls(spark, profile)
    assert seeds.count() == 79
    start = T.empty_tables(spark)
    added, queued = dedup.load_seeds(seeds, start.urls, F.lit(NOW), profile)
    assert added.count() == queued.count() == 79
    assert {(r.status, r.depth, r.priority) for r in queued.collect()} == {("queued", 0, 10)}
    first = added.agg(F.min("url")).first()[0]
    assert first == "https://portal.test/ru/hubs/machine_learning/articles/page21/"
    again, queued_again = dedup.load_seeds(seeds, added, F.lit(NOW), profile)
    assert again.count() == queued_again.count() == 0


def _offers(spark, rows):
    return spark.createDataFrame(
        [(u, p, d, NOW + timedelta(seconds=d)) for u, p, d in rows],
        "url string, discovered_from string, parent_depth int, discovered_at timestamp",
    )


def test_frontier_admission(spark, profile):
    site = "https://portal.test/ru"
    frontier = spark.createDataFrame([(f"{site}/articles/9/",)], "url string")
    offers = _offers(
        spark,
        [
            (f"{site}/articles/1/", "b", 1),
            (f"{site}/articles/1/", "c", 0),
            (f"{site}/articles/1/", "a", 1),
            (f"{site}/articles/2/", "a", 2),
            (f"{site}/articles/9/", "a", 0),
            (f"{site}/news/3/", "a", 0),
        ],
    )
    got = dedup.expand_frontier(offers, frontier, profile)
    assert got.columns == schemas.FRONTIER.fieldNames()
    rows = got.collect()
    assert [(r.url, r.depth, r.priority, r.discovered_from, r.status) for r in rows] == [
        (f"{site}/articles/1/", 1, 100, "c", "queued")
    ]


def test_rejected_urls(spark):
    df = spark.createDataFrame([("xmpp:a@b/",), ("http://h/",)], "url string")
    assert [tuple(r) for r in dedup.rejected_urls(df).collect()] == [("xmpp:a@b/", "unsupported scheme")]


def test_anti_joins_prefilter_known_urls_above_the_bound(spark, profile, monkeypatch):
    """Above the broadcast bound of strings, 64-bit hashes of the candidates are broadcast and
    only known URLs that can match reach the anti-join; results are unchanged."""
    from pyspark.sql import functions as F

    from linkloom.operators import dedup, lookup

    found = spark.createDataFrame(
        [(f"https://portal.test/a/{k}/", None) for k in range(60)], "url string, discovered_at timestamp"
    ).withColumn("discovered_at", F.current_timestamp())
    known = spark.createDataFrame([(f"https://portal.test/a/{k}/",) for k in range(0, 600, 3)], "url string")
    want = {r.url for r in dedup.new_urls(found, known, profile).collect()}
    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", 0)
    near = lookup.near(known, found, "url")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan and "BroadcastHashJoin" in plan
    assert {r.url for r in near.collect()} == {f"https://portal.test/a/{k}/" for k in range(0, 60, 3)}
    assert {r.url for r in dedup.new_urls(found, known, profile).collect()} == want
    assert len(want) == 40
