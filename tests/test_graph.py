import random

from linkloom import SiteProfile
from linkloom.operators import graph


def walk(seeds, edges, max_depth, hashes=None):
    """Breadth-first expansion as a loop over a queue ordered by (depth, URL)."""
    depth, parent, seen = {s: 0 for s in seeds}, {s: None for s in seeds}, set()
    level = sorted(seeds)
    for d in range(max_depth):
        found = {}
        for url in level:
            if hashes is not None:
                if url not in hashes:
                    continue
                h = hashes[url]
                if h is not None and h in seen:
                    continue
                seen.add(h)
            for target in edges.get(url, ()):
                if target not in depth:
                    found.setdefault(target, url)
        for target, source in found.items():
            depth[target], parent[target] = d + 1, source
        level = sorted(found)
    return {u: (depth[u], parent[u]) for u in depth}


def test_levels_equal_loop_with_and_without_content_pruning(spark):
    rng = random.Random(8)
    names = [f"n{i:03d}" for i in range(400)]
    pairs = [("n000" if rng.random() < 0.3 else rng.choice(names), rng.choice(names)) for _ in range(900)]
    edges = {}
    for a, b in pairs:
        edges.setdefault(a, []).append(b)
    hashes = {n: rng.choice([None, "same", f"h{rng.randrange(60)}"]) for n in names if rng.random() < 0.9}
    seeds = ["n000", "n001", "n002"]
    site = SiteProfile(host_suffix="x", max_depth=3)
    edge_df = spark.createDataFrame(pairs, "from_url string, to_url string")
    seed_df = spark.createDataFrame([(s,) for s in seeds], "url string")
    page_df = spark.createDataFrame(list(hashes.items()), "url string, content_hash string")
    for pages, table in ((None, None), (page_df, hashes)):
        got = graph.breadth_first(seed_df, edge_df, site, pages, crawlable_only=False)
        assert {r.url: (r.depth, r.discovered_from) for r in got.collect()} == walk(seeds, edges, 3, table)


def test_only_crawlable_targets_are_reached(spark, profile):
    a, b, c = (f"https://portal.test/ru/{p}/" for p in ("articles/1", "articles/2", "news/3"))
    seeds = spark.createDataFrame([(a,)], "url string")
    edges = spark.createDataFrame([(a, b), (a, c), (b, a)], "from_url string, to_url string")
    got = graph.breadth_first(seeds, edges, profile).collect()
    assert {(r.url, r.depth) for r in got} == {(a, 0), (b, 1)}


def test_paths_follow_parents(spark, profile):
    rows = [("s", 0, None), ("a", 1, "s"), ("b", 2, "a")]
    df = spark.createDataFrame(rows, "url string, depth int, discovered_from string")
    got = {r.url: r.path for r in graph.discovery_paths(df, profile).collect()}
    assert got == {"s": ["s"], "a": ["s", "a"], "b": ["s", "a", "b"]}


def test_hot_source_and_hot_parent_are_split(spark, profile, monkeypatch):
    """Above the broadcast bound a source with many links is dealt over several salts, and
    paths from pointer doubling equal level-by-level paths."""
    from dataclasses import replace

    from linkloom.operators import graph, lookup, skew

    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(lookup, "MAX_BROADCAST_IDS", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    deep = replace(profile, max_depth=5)
    edges = [("s", f"a{i}") for i in range(400)] + [(f"a{i}", f"b{i % 7}") for i in range(400)]
    edges += [("b0", "c0"), ("c0", "d0"), ("d0", "e0"), ("e0", "f0"), ("f0", "g0")]
    edge_df = spark.createDataFrame(edges, "from_url string, to_url string")
    seeds = spark.createDataFrame([("s",)], "url string")
    levels = graph.breadth_first(seeds, edge_df, deep, crawlable_only=False)
    got = {r.url: (r.depth, r.discovered_from) for r in levels.collect()}
    want = {"s": (0, None), **{f"a{i}": (1, "s") for i in range(400)}}
    want |= {f"b{k}": (2, min((f"a{i}" for i in range(400) if i % 7 == k))) for k in range(7)}
    want |= {"c0": (3, "b0"), "d0": (4, "c0"), "e0": (5, "d0")}
    assert got == want
    paths = {r.url: r.path for r in graph.discovery_paths(levels, deep).collect()}
    for url, (depth, parent) in want.items():
        chain = [url]
        while want[chain[0]][1] is not None:
            chain.insert(0, want[chain[0]][1])
        assert paths[url] == chain and len(chain) == depth + 1
    plan = graph.salted_join(
        edge_df, seeds.withColumnRenamed("url", "from_url"), "from_url", ["to_url"],
        skew.hot_keys(edge_df, "from_url"),
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
