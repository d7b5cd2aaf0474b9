"""Batch and streaming ingest against a loop that handles one result at a time."""

import hashlib
import random
from dataclasses import dataclass, field
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linkloom import schemas
from linkloom.operators import dedup
from linkloom.plans import report
from linkloom.operators.ingest import apply_results, merge
from linkloom.sources import tables as T
from linkloom.streaming import store

NOW = datetime(2024, 1, 1)
SITE = "https://portal.test"


def article(n):
    return f"{SITE}/ru/articles/{n}/"


def result(url, at, html=None, error=None, content_type="text/html"):
    """One RAW row; ``html`` is the body."""
    failed = error is not None
    body = None if failed else html
    is_html = None if failed else "text/html" in content_type
    return (
        url, url, None if failed else 200, None if failed else content_type,
        None if body is None else len(body.encode()), body, 5, is_html, error, NOW + timedelta(seconds=at),
    )


def page(text, *links):
    return f"<p>{text}</p>" + "".join(f'<a href="{u}">to</a>' for u in links)


@dataclass
class Crawl:
    """The tables as dicts, and the routing rule as a loop."""

    frontier: dict = field(default_factory=dict)
    urls: set = field(default_factory=set)
    pages: dict = field(default_factory=dict)
    links: list = field(default_factory=list)
    attempts: int = 0

    def seed(self, urls):
        for u in urls:
            self.urls.add(u)
            self.frontier[u] = ["queued", 0, 0, None]

    def handle(self, results, links_of, max_depth=2):
        """Rounds: results of known URLs, then of the URLs these rounds find."""
        self.attempts += len(results)
        turn = {u for u, entry in self.frontier.items() if entry[0] in ("queued", "fetching")}
        for _ in range(max_depth + 1):
            turn = self._round([r for r in results if r[0] in turn], links_of, max_depth)

    def _round(self, results, links_of, max_depth):
        found = {}
        for row in sorted(results, key=lambda r: (r[9], r[0])):
            url, html, is_html, error = row[0], row[5], row[7], row[8]
            entry = self.frontier[url]
            if entry[0] not in ("queued", "fetching"):
                continue
            if error is not None:
                entry[2] += 1
                if entry[2] >= 3:
                    entry[0], entry[3] = "failed", error
                continue
            entry[0] = "done"
            if not is_html:
                self.pages[url] = None
                continue
            text, links = links_of[html]
            digest = hashlib.sha256(text.encode()).hexdigest() if text else None
            if digest is not None and digest in self.pages.values():
                continue
            self.pages[url] = digest
            for pos, target in enumerate(links):
                self.urls.add(target)
                self.links.append((url, pos, target))
                if entry[1] < max_depth and "/ru/articles/" in target and target not in self.frontier:
                    found[target] = min(found.get(target, (entry[1], url)), (entry[1], url))
        # Links of one round are offered together.
        for target, (depth, _) in found.items():
            self.frontier[target] = ["queued", depth + 1, 0, None]
        return set(found)


def view(tables):
    """Tables in the shape of ``Crawl``."""
    frontier = {
        r.url: [r.status, r.depth, r.attempt_count, r.last_error] for r in tables.frontier.collect()
    }
    return Crawl(
        frontier,
        {r.url for r in tables.urls.collect()},
        {r.url: r.content_hash for r in tables.pages.collect()},
        sorted((r.from_url, r.pos, r.to_url) for r in tables.links.collect()),
        tables.fetch_attempts.count(),
    )


def start_tables(spark, profile, seeds):
    empty = T.empty_tables(spark)
    added, queued = dedup.load_seeds(
        spark.createDataFrame([(s,) for s in seeds], "url string"), empty.urls, F.lit(NOW), profile
    )
    return T.CrawlTables(added, queued, empty.pages, empty.links, empty.fetch_attempts)


def snapshot(spark, tables, path):
    T.write_tables(tables, str(path))
    return T.read_tables(spark, str(path))


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW)


def test_html_other_and_error_results(spark, profile, tmp_path):
    seeds = [article(1), f"{SITE}/file.pdf/", article(3)]
    tables = start_tables(spark, profile, seeds)
    rows = [
        result(article(1), 1, page("body", "/ru/articles/99?utm_source=x")),
        result(f"{SITE}/file.pdf", 2, "binary-ish", content_type="application/pdf"),
        result(article(3), 3, error="network failure"),
    ]
    applied = apply_results(raw(spark, rows), tables, profile)
    assert {(r.url, r.outcome) for r in applied.outcomes.collect()} == {
        (article(1), "page"), (f"{SITE}/file.pdf/", "other page"), (article(3), "retry"),
    }
    after = snapshot(spark, merge(tables, applied.added), tmp_path / "1")
    got = view(after)
    assert got.attempts == 3 and len(got.pages) == 2
    assert got.links == [(article(1), 0, article(99))]
    assert got.frontier == {
        article(1): ["done", 0, 0, None], f"{SITE}/file.pdf/": ["done", 0, 0, None],
        article(3): ["queued", 0, 1, None], article(99): ["queued", 1, 0, None],
    }
    pdf = after.pages.filter(F.col("url").endswith(".pdf/")).first()
    assert (pdf.html, pdf.is_html, pdf.content_type) == (None, False, "application/pdf")

    # The discovered page comes next; it fails too.
    applied = apply_results(raw(spark, [result(article(99), 4, error="timed out")]), after, profile)
    got = view(merge(after, applied.added))
    assert got.attempts == 4 and len(got.pages) == 2 and got.frontier[article(99)] == ["queued", 1, 1, None]


def test_duplicate_content_adds_no_page_and_no_links(spark, profile, tmp_path):
    tables = start_tables(spark, profile, [article(1), article(2), article(3)])
    first = apply_results(raw(spark, [result(article(1), 1, page("same to"))]), tables, profile)
    after = snapshot(spark, merge(tables, first.added), tmp_path / "1")
    rows = [result(article(2), 2, page("same", "/ru/articles/7/")), result(article(3), 3, page("other"))]
    second = apply_results(raw(spark, rows), after, profile)
    assert {(r.url, r.outcome) for r in second.outcomes.collect()} == {(article(2), "duplicate"), (article(3), "page")}
    got = view(merge(after, second.added))
    assert got.links == [] and set(got.pages) == {article(1), article(3)}
    assert got.frontier[article(2)][0] == "done"


def test_disallowed_urls_fail_without_content(spark, profile):
    url = f"{SITE}/search/x/"
    tables = start_tables(spark, profile, [url])
    applied = apply_results(raw(spark, [result(url, 1, page("x"))]), tables, profile, enforce_robots=True)
    row = applied.added.fetch_attempts.first()
    assert (row.success, row.error_type, row.error_message, row.http_status) == (
        False, "request_error", "Blocked by robots.txt", None,
    )
    assert applied.added.pages.count() == 0
    assert applied.outcomes.first().outcome == "retry"


@pytest.mark.parametrize("parts", [1, 4, 8])
def test_equal_times_do_not_depend_on_the_order_of_rows(spark, profile, parts):
    a, b = article(1), article(2)
    rows = [result(a, 0, error=f"timed out {k}") for k in range(3)]
    rows += [result(a, 0, page(f"good {k}")) for k in range(3)]
    rows += [result(b, 0, error=f"boom {k}") for k in range(4)]
    tables = start_tables(spark, profile, [a, b])
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        applied = apply_results(raw(spark, rows).repartition(parts), tables, profile)
        got = sorted((r.url, r.outcome) for r in applied.outcomes.collect())
        states = sorted((r.url, r.status, r.last_error) for r in applied.added.frontier.collect())
        seen.add((*got, *states, applied.added.pages.first().content_hash))
    (only,) = seen
    assert only[:2] == ((a, "page"), (b, "gave up")) and only[3] == (b, "failed", "boom 2")


def random_crawl(seed=6):
    """Batches of results in time order, and what each body parses to."""
    rng = random.Random(seed)
    seeds = [article(i) for i in range(20)]
    known, batches, parsed, at = list(seeds), [], {}, 0
    for _ in range(3):
        rows = []
        ahead = [article(rng.randrange(60)) for _ in range(15)]
        for url in rng.sample(known, len(known)) + sorted(set(ahead) - set(known)):
            for _ in range(rng.choice([1, 1, 2, 4])):
                at += 1
                kind = rng.random()
                if kind < 0.4:
                    rows.append(result(url, at, error=rng.choice(["timed out", "boom"])))
                elif kind < 0.5:
                    rows.append(result(url, at, "x", content_type="image/png"))
                else:
                    targets = [article(rng.randrange(60)) for _ in range(rng.randrange(4))]
                    targets += [f"https://other.test/{rng.randrange(5)}/"]
                    text = rng.choice(["copied text", f"text {at}", f"text {rng.randrange(9)}"])
                    body = f"<p>{text}</p>" + "".join(f'<a href="{t}"></a>' for t in targets)
                    parsed[body] = (text, targets)
                    rows.append(result(url, at, body))
        batches.append(rows)
        # Also pages found in this batch, and some that only copies link to.
        known = sorted({t for _, ts in parsed.values() for t in ts if SITE in t} | set(known))
    return seeds, batches, parsed


def expected_crawl(seeds, batches, parsed):
    crawl = Crawl()
    crawl.seed(seeds)
    for rows in batches:
        crawl.handle(rows, parsed)
    crawl.links.sort()
    return crawl


def test_batches_equal_loop(spark, profile, tmp_path):
    seeds, batches, parsed = random_crawl()
    tables = start_tables(spark, profile, seeds)
    for i, rows in enumerate(batches):
        added = apply_results(raw(spark, rows), tables, profile).added
        tables = snapshot(spark, merge(tables, added), tmp_path / f"snapshot{i}")
    assert view(tables) == expected_crawl(seeds, batches, parsed)


def test_stream_equals_loop_and_replay_changes_nothing(spark, profile, tmp_path):
    seeds, batches, parsed = random_crawl(seed=12)
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "store", "checkpoint"))
    store.create_store(spark, root, start_tables(spark, profile, seeds), profile)
    for rows in batches:
        raw(spark, rows).coalesce(1).write.mode("append").parquet(source)
        store.start_ingest(
            store.stream_results(spark, source), root, checkpoint, profile
        ).awaitTermination()
    want = expected_crawl(seeds, batches, parsed)
    assert view(store.read_store(spark, root)) == want
    assert _live(spark, root, profile) == _report_rows(store.read_store(spark, root), profile)
    store.batch_writer(root, profile)(raw(spark, batches[2]), 2)
    assert view(store.read_store(spark, root)) == want
    assert _live(spark, root, profile) == _report_rows(store.read_store(spark, root), profile)
    assert len(view(store.read_store(spark, root, before=0)).pages) == 0

    # A store started from the tables of another one goes on with the same stream.
    compact = str(tmp_path / "compact")
    store.create_store(spark, compact, store.read_store(spark, root), profile)
    more = [result(article(500), 10_000, page("late"))]
    raw(spark, more).coalesce(1).write.mode("append").parquet(source)
    stream = store.stream_results(spark, source)
    store.start_ingest(stream, compact, checkpoint, profile).awaitTermination()
    want.handle(more, {more[0][5]: ("late", [])})
    assert view(store.read_store(spark, compact)) == want
    assert _live(spark, compact, profile) == _report_rows(store.read_store(spark, compact), profile)


def _report_rows(tables, profile):
    return sorted(tuple(r) for r in report.crawl_report(tables, profile).collect())


def _live(spark, root, profile):
    """The report summed from the counts that each micro-batch wrote."""
    return sorted(tuple(r) for r in store.read_report(spark, root).collect())


def test_frontier_rows_are_looked_up_before_the_latest_is_taken(spark, profile, tmp_path):
    root = str(tmp_path / "store")
    store.create_store(spark, root, start_tables(spark, profile, [article(1)]), profile)
    history = store.read_store(spark, root, history=True).frontier
    keys = spark.createDataFrame([(article(1),)], "url string")
    found = store.latest_rows(history.join(keys, "url", "left_semi"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")
    assert found.columns == schemas.FRONTIER.fieldNames() and found.count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_raw_results_read_back(spark, tmp_path, fmt):
    rows = [result(article(1), 1, page("x")), result(article(2), 2, error="boom")]
    raw(spark, rows).write.format(fmt).save(str(tmp_path / fmt))
    got = T.read_results(spark, str(tmp_path / fmt), fmt)
    assert sorted(map(tuple, got.collect())) == sorted(rows)


def test_tables_round_trip_and_sql(spark, profile, tmp_path):
    tables = start_tables(spark, profile, [article(1), article(2)])
    added = apply_results(
        raw(spark, [result(article(1), 1, page("x", "https://other.test/a"))]), tables, profile
    ).added
    after = merge(tables, added)
    T.write_tables(after, str(tmp_path / "snapshot"))
    back = T.read_tables(spark, str(tmp_path / "snapshot"))
    for (name, a), (_, b) in zip(after.items(), back.items()):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
        assert a.columns == b.columns == schemas.TABLES[name].fieldNames()
    back.register_views()
    hosts = spark.sql("SELECT DISTINCT host FROM urls WHERE url IN (SELECT to_url FROM links)")
    assert [r.host for r in hosts.collect()] == ["other.test"]
    got = report.top_external_hosts(back, profile)
    assert [tuple(r) for r in got.collect()] == [("other.test", 1)]


def test_snapshot_updated_by_changed_parts(spark, profile, tmp_path):
    """An update writes the growing tables' new folder and rewrites only the statuses it changes;
    running it again gives the same snapshot."""
    import os

    root = str(tmp_path / "snapshot")
    tables = start_tables(spark, profile, [article(k) for k in range(1, 6)])
    first = apply_results(raw(spark, [result(article(1), 1, error="boom")]), tables, profile).added
    tables = merge(tables, first)
    T.write_tables(tables, root)
    snapshot = T.read_tables(spark, root)
    added = apply_results(
        raw(spark, [result(article(2), 2, page("y", "https://other.test/b"))]), snapshot, profile
    ).added
    want = merge(snapshot, added)
    want_rows = {name: sorted(map(str, df.collect())) for name, df in want.items()}
    statuses = {r.status for r in T.read_tables(spark, root).frontier.select("status").distinct().collect()}
    untouched = statuses - {"queued", "done"}

    def stamps():
        return {
            s: sorted(os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/frontier/status={s}") for f in fs)
            for s in untouched
        }

    before = stamps()
    for _ in range(2):  # the second run is a rerun of the same batch
        T.update_tables(spark, root, added, 0)
        back = T.read_tables(spark, root)
        for name, df in back.items():
            assert sorted(map(str, df.collect())) == want_rows[name], name
    assert stamps() == before
