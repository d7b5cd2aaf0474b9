"""Near-duplicate embeddings: hierarchical navigable small-world graphs, one a shard.

Vectors of one label that are equal form a class. The classes of a label are dealt by hash into
shards of bounded size, and a graph is built for each shard: a node has a random level, each
level links a node to near and diverse neighbours. Every class then queries every shard of its
label: from the top level down a beam search finds the neighbourhood, and on the ground level
the search goes on from every node that is near enough, so a large group of near copies is
walked through whatever the beam holds.

After each search an audit compares queries, drawn until ``AUDIT`` of them have one to ``FEW``
links, with all other vectors of the shard; where links are rare that is every query. The share
found of a query's links is averaged over queries with few and with more links apart. Below
``RECALL`` for either, the beam is doubled and the search repeated; links that the audit saw are
added in any case. Links are tested by cosine in double precision. Components are made in each tile, then over all tiles.

A task holds two shards and the bit table of their links, whatever the size of a label.
Numpy works inside the tasks; Spark deals out the shards and pairs of shards.

Defined cases: null labels; null, empty and zero vectors; and vectors with null or non-finite
components link with nothing. Vectors of different lengths do not link. Repeated rows are
vectors of their own and link with each other. An empty table gives no rows. A class is known by
a 64-bit hash of label and vector. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.components import components
from linkloom.scratch import stage

COSINE = 0.93
SHARD = 6_000
M = 12  # neighbours on the upper levels; twice as many on the ground
BUILD_BEAM = 32
BEAM = 24
SLACK = 0.06  # the walk goes on through nodes this much below the threshold
RECALL = 0.98
AUDIT = 64
FEW = 4
_BATCH = 512
_QUERIES = 1024
_EXPAND = 4


def beam_search(x: np.ndarray, near: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and cosines of the best ``width`` nodes found for each query, all queries in step.

    ``near`` lists each node's neighbours (-1: none), ``entry`` a first node for each query.
    """
    b = len(q)
    seen = np.zeros((b, len(x)), bool)
    ids = np.full((b, width), -1, np.int64)
    cos = np.full((b, width), -np.inf, np.float32)
    shut = np.ones((b, width), bool)
    ids[:, 0], shut[:, 0] = entry, False
    cos[:, 0] = np.einsum("bd,bd->b", x[entry], q)
    seen[np.arange(b), entry] = True
    rows = np.arange(b)
    expand = min(_EXPAND, width)
    while len(rows):
        open_cos = np.where(shut[rows], -np.inf, cos[rows])
        best = np.argpartition(-open_cos, expand - 1, axis=1)[:, :expand]
        usable = np.take_along_axis(open_cos, best, 1) > -np.inf
        going = usable.any(1)
        rows, best, usable = rows[going], best[going], usable[going]
        if not len(rows):
            break
        np.put_along_axis(w := shut[rows], best, True, 1)
        shut[rows] = w
        nodes = np.where(usable, np.take_along_axis(ids[rows], best, 1), 0)
        next_ids = np.where(usable[:, :, None], near[nodes], -1).reshape(len(rows), -1)
        next_ids.sort(1)
        fresh = (next_ids >= 0) & ~seen[rows[:, None], next_ids]
        fresh[:, 1:] &= next_ids[:, 1:] != next_ids[:, :-1]
        r, c = np.nonzero(fresh)
        seen[rows[r], next_ids[r, c]] = True
        next_cos = np.full(next_ids.shape, -np.inf, np.float32)
        next_cos[r, c] = np.einsum("bd,bd->b", x[next_ids[r, c]], q[rows[r]])
        all_ids = np.concatenate((ids[rows], next_ids), 1)
        all_cos = np.concatenate((cos[rows], next_cos), 1)
        all_shut = np.concatenate((shut[rows], ~fresh), 1)
        top = np.argpartition(-all_cos, width - 1, axis=1)[:, :width]
        ids[rows] = np.take_along_axis(all_ids, top, 1)
        cos[rows] = np.take_along_axis(all_cos, top, 1)
        shut[rows] = np.take_along_axis(all_shut, top, 1)
    ids[cos == -np.inf] = -1
    return ids, cos


def _diverse(x: np.ndarray, ids: np.ndarray, cos: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the row than to one chosen before;
    free places are filled with the nearest of the rest."""
    order = np.argsort(-cos, axis=1, kind="stable")
    ids, cos = np.take_along_axis(ids, order, 1), np.take_along_axis(cos, order, 1)
    b, n = ids.shape
    chosen = np.full((b, most), -1, np.int64)
    count = np.zeros(b, np.int64)
    taken = np.zeros((b, n), bool)
    for k in range(n):
        live = (ids[:, k] >= 0) & (count < most)
        if not live.any():
            break
        r = np.flatnonzero(live)
        v = x[ids[r, k]]
        others = np.einsum("bmd,bd->bm", x[np.maximum(chosen[r], 0)], v)
        closest = np.where(chosen[r] >= 0, others, -np.inf).max(1)
        good = r[closest < cos[r, k]]
        chosen[good, count[good]] = ids[good, k]
        count[good] += 1
        taken[good, k] = True
    for k in range(n):
        r = np.flatnonzero((ids[:, k] >= 0) & ~taken[:, k] & (count < most))
        chosen[r, count[r]] = ids[r, k]
        count[r] += 1
    return chosen


class Graph:
    """Levels of neighbour lists over unit vectors; level 0 holds all nodes."""

    def __init__(self, x: np.ndarray, near: list[np.ndarray], entry: int) -> None:
        self.x, self.near, self.entry = x, near, entry

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 3) -> Graph:
        n = len(x)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(rng.random(n)) / np.log(M)).astype(int), 6)
        order = np.argsort(-levels, kind="stable")  # higher levels first, so entries exist
        top = int(levels.max(initial=0))
        near = [np.full((n, 2 * M if k == 0 else M), -1, np.int64) for k in range(top + 1)]
        graph = cls(x, near, int(order[0]) if n else 0)
        at = 0
        while at < n:
            batch = order[at : at + max(32, min(_BATCH, at))]
            graph._insert(batch, levels, at)
            at += len(batch)
        return graph

    def _insert(self, batch: np.ndarray, levels: np.ndarray, before: int) -> None:
        q = self.x[batch]
        entry = np.full(len(batch), self.entry)
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        for level in range(len(self.near) - 1, -1, -1):
            here = levels[batch] >= level
            ids = np.full((len(batch), 0), -1, np.int64)
            cos = np.zeros((len(batch), 0), np.float32)
            if before:
                ids, cos = beam_search(self.x, self.near[level], q, entry, BUILD_BEAM)
                entry = ids[np.arange(len(batch)), cos.argmax(1)]
            rows = np.flatnonzero(here)
            if not len(rows):
                continue
            peers = among[np.ix_(rows, rows)]
            some = min(len(rows), BUILD_BEAM)
            part = np.argpartition(-peers, some - 1, axis=1)[:, :some]
            peer_cos = np.take_along_axis(peers, part, 1)
            peer_ids = np.where(peer_cos > -np.inf, batch[rows][part], -1)
            ids = np.concatenate((ids[rows], peer_ids), 1)
            cos = np.where(ids >= 0, np.concatenate((cos[rows], peer_cos), 1), -np.inf)
            width = self.near[level].shape[1]
            chosen = _diverse(self.x, ids, cos, M)
            self.near[level][batch[rows], : chosen.shape[1]] = chosen
            self._link_back(level, np.repeat(batch[rows], chosen.shape[1]), chosen.ravel(), width)

    def _link_back(self, level: int, source: np.ndarray, target: np.ndarray, width: int) -> None:
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(nodes), 256):
            own, f, c = nodes[a : a + 256], first[a : a + 256], count[a : a + 256]
            new = np.full((len(own), int(c.max())), -1, np.int64)
            row = np.repeat(np.arange(len(own)), c)
            place = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
            new[row, place] = source[np.repeat(f, c) + place]
            ids = np.concatenate((self.near[level][own], new), 1)
            ids.sort(1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            cos = np.einsum("bmd,bd->bm", self.x[np.maximum(ids, 0)], self.x[own])
            self.near[level][own] = _diverse(self.x, ids, np.where(ids >= 0, cos, -np.inf), width)

    def near_pairs(self, q: np.ndarray, width: int, floor: float) -> np.ndarray:
        """Bit table (query, node) of the nodes found with a cosine of ``floor`` or more."""
        out = np.zeros((len(q), len(self.x)), bool)
        for a in range(0, len(q), _QUERIES):
            part = q[a : a + _QUERIES]
            entry = np.full(len(part), self.entry)
            for level in range(len(self.near) - 1, 0, -1):
                ids, cos = beam_search(self.x, self.near[level], part, entry, _EXPAND)
                entry = ids[np.arange(len(part)), cos.argmax(1)]
            ids, cos = beam_search(self.x, self.near[0], part, entry, width)
            self._walk(part, ids, cos, floor, out[a : a + _QUERIES])
        return out

    def _walk(self, q: np.ndarray, ids: np.ndarray, cos: np.ndarray, floor: float, out: np.ndarray) -> None:
        """Go on from all nodes within ``SLACK`` of ``floor``, not only from those in the beam."""
        seen = np.zeros(out.shape, bool)
        row, col = np.nonzero((ids >= 0) & (cos >= floor - SLACK))
        node, value = ids[row, col], cos[row, col]
        seen[row, node] = True
        out[row[value >= floor], node[value >= floor]] = True
        while len(row):
            next_row, next_node = [], []
            for a in range(0, len(row), 50_000):
                r, v = row[a : a + 50_000], node[a : a + 50_000]
                n = self.near[0][v]
                r, n = np.repeat(r, n.shape[1]), n.ravel()
                keep = (n >= 0) & ~seen[r, n]
                r, n = np.divmod(np.unique(r[keep] * len(self.x) + n[keep]), len(self.x))
                seen[r, n] = True
                value = np.einsum("bd,bd->b", self.x[n], q[r])
                out[r[value >= floor], n[value >= floor]] = True
                go = value >= floor - SLACK
                next_row.append(r[go])
                next_node.append(n[go])
            row, node = np.concatenate(next_row), np.concatenate(next_node)


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(1, keepdims=True))


def _passes(found: np.ndarray, truth: np.ndarray) -> bool:
    """Whether queries with few links and queries with more both found enough of theirs."""
    n = truth.sum(1)
    share = (found & truth).sum(1) / np.maximum(n, 1)
    return all(share[kind].mean() >= RECALL for kind in ((n > 0) & (n <= FEW), n > FEW) if kind.any())


def _audited(graph: Graph, q: np.ndarray, floor: float, same: bool = False) -> np.ndarray:
    """Links of the queries, the beam widened until the audit passes.

    ``same``: the queries are the nodes, and a node's link with itself proves nothing.
    """
    order = np.random.default_rng(len(q)).permutation(len(q))
    truths, few, at = [], 0, 0
    while at < len(q) and few < AUDIT:
        part = order[at : at + _BATCH]
        truth = q[part] @ graph.x.T >= floor
        if same:
            truth[np.arange(len(part)), part] = False
        truths.append(truth)
        n = truth.sum(1)
        few += int(((n > 0) & (n <= FEW)).sum())
        at += len(part)
    checked, truth = order[:at], np.concatenate(truths)
    width = BEAM
    while True:
        found = graph.near_pairs(q, min(width, len(graph.x)), floor)
        # With all queries checked no link is missing, whatever the beam.
        if at == len(q) or width >= len(graph.x) or _passes(found[checked], truth):
            found[checked] |= truth
            return found
        width *= 2


def _verified(found: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Clear the pairs of ``found`` whose cosine in double precision is below ``COSINE``."""
    for k in range(0, len(found), 256):
        r, c = np.nonzero(found[k : k + 256])
        for s in range(0, len(r), 100_000):
            i, j = r[s : s + 100_000], c[s : s + 100_000]
            low = np.einsum("bd,bd->b", a[k + i], b[j]) < COSINE
            found[k + i[low], j[low]] = False


def tile_links(a: tuple, b: tuple | None) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Weighted link counts of both shards and a spanning forest of their links.

    A shard is (ids, copies, raw vectors, graph); without ``b`` it is compared with itself.
    """
    floor = COSINE - 1e-5
    ua = _unit(a[2])
    if b is None:
        found = _audited(a[3], a[3].x, floor, same=True)
        found |= found.T
        np.fill_diagonal(found, False)
        ub, ids = ua, (a[0], a[0])
    else:
        ub, ids = _unit(b[2]), (a[0], b[0])
        found = _audited(b[3], a[3].x, floor)
        found |= _audited(a[3], b[3].x, floor).T
    _verified(found, ua, ub)
    copies_b = a[1] if b is None else b[1]
    # By parts, because a product of bits and numbers would copy the whole table.
    to_a = np.concatenate([found[k : k + 512] @ copies_b for k in range(0, len(found), 512)])
    to_b = sum(a[1][k : k + 512] @ found[k : k + 512] for k in range(0, len(found), 512))
    forest = []
    left = np.ones(len(found), bool)
    back = found.T if b is not None else found
    free = np.ones(found.shape[1], bool)
    for start in np.flatnonzero(found.any(1)):
        if not left[start]:
            continue
        left[start] = False
        if b is None:
            free[start] = False
        rows = np.array([start])
        while len(rows):
            cols = np.flatnonzero(found[rows].any(0) & free)
            free[cols] = False
            forest += [(int(ids[1][c]), int(ids[0][start])) for c in cols]
            if b is None:
                rows = cols
                left[cols] = False
                continue
            rows = np.flatnonzero(back[cols].any(0) & left) if len(cols) else cols
            left[rows] = False
            forest += [(int(ids[0][r]), int(ids[0][start])) for r in rows]
    return to_a, to_b, forest


SHARD_SCHEMA = "label string, dim int, shard long, ids binary, copies binary, raw binary, levels int, near binary, entry long"


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("node").combine_chunks()
    n = table.num_rows
    raw = table["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    graph = Graph.build(_unit(raw).astype(np.float32))
    near = np.concatenate([g.astype(np.int32).ravel() for g in graph.near])
    first = {k: table[k][0].as_py() for k in ("label", "dim", "shard")}
    row = first | {
        "ids": table["node"].to_numpy().astype(np.int64).tobytes(),
        "copies": table["copies"].to_numpy().astype(np.int64).tobytes(),
        "raw": raw.tobytes(), "levels": len(graph.near), "near": near.tobytes(), "entry": graph.entry,
    }
    kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 3, pa.int32(), pa.binary(), pa.int64()]
    return pa.table({k: pa.array([v], t) for (k, v), t in zip(row.items(), kinds)})


def _loaded(row: dict) -> tuple:
    ids, copies = (np.frombuffer(row[k], np.int64) for k in ("ids", "copies"))
    raw = np.frombuffer(row["raw"], np.float64).reshape(len(ids), -1)
    flat, near, at = np.frombuffer(row["near"], np.int32), [], 0
    for level in range(row["levels"]):
        size = len(ids) * (2 * M if level == 0 else M)
        near.append(flat[at : at + size].reshape(len(ids), -1).astype(np.int64))
        at += size
    return ids, copies, raw, Graph(_unit(raw).astype(np.float32), near, row["entry"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names)}
            a, b = row["a"], row["b"]
            left, right = _loaded(a), _loaded(b) if b else None
            to_a, to_b, forest = tile_links(left, right)
            nodes = [left[0][to_a > 0], np.array([u for u, _ in forest], np.int64)]
            counts = [to_a[to_a > 0], np.zeros(len(forest), np.int64)]
            others = [None] * int((to_a > 0).sum()) + [v for _, v in forest]
            if right:
                nodes.append(right[0][to_b > 0])
                counts.append(to_b[to_b > 0])
                others += [None] * int((to_b > 0).sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(nodes)), pa.array(others, pa.int64()), pa.array(np.concatenate(counts).astype(np.int64))],
                ["u", "v", "n"],
            )


def join(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row of ``vectors``: key, ``n_links``, ``component_id`` and ``kept``."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col(label).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    node = F.xxhash64(F.col(label).cast("string"), v)
    rows = vectors.select(
        F.col(key).alias("key"), F.col(label).cast("string").alias("label"), v.alias("vec"),
        F.when(F.coalesce(good, F.lit(False)), node).alias("node"),
    )
    classes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"),
        F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"),
    )
    classes = stage(classes.withColumn("dim", F.size("vec")), "classes")
    parts = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("parts"))
    dealt = classes.join(parts, ["label", "dim"]).select(
        "label", "dim", F.pmod(F.xxhash64("node"), "parts").alias("shard"), "node", "vec", "copies"
    )
    shards = stage(dealt.groupBy("label", "dim", "shard").applyInArrow(_build, SHARD_SCHEMA), "graphs")
    a = shards.select("label", "dim", F.col("shard").alias("i"), F.struct(*shards.columns).alias("a"))
    b = shards.select("label", "dim", F.col("shard").alias("j"), F.struct(*shards.columns).alias("b"))
    pairs = shards.select("label", "dim", F.col("shard").alias("i")).join(
        shards.select("label", "dim", F.col("shard").alias("j")), ["label", "dim"]
    ).filter("i <= j")
    tiles = pairs.join(a, ["label", "dim", "i"]).join(b, ["label", "dim", "j"])
    tiles = tiles.select("a", F.when(F.col("i") < F.col("j"), F.col("b")).alias("b"))
    found = stage(_spread(tiles).mapInArrow(_tiles, "u long, v long, n long"), "found")
    linked = components(found.filter("v IS NOT NULL").select("u", "v"))
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    named = classes.select("node", "copies", "least").join(linked, "node", "left")
    named = named.withColumn("grp", F.coalesce("component", "node"))
    heads = named.groupBy("grp").agg(F.min("least").alias("head"))
    named = named.join(heads, "grp").join(counts, F.col("node") == F.col("u"), "left").select(
        F.col("node").alias("_node"), "head", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    out = rows.select("key", "node").join(named, F.col("node") == F.col("_node"), "left")
    head = F.coalesce("head", "key")
    return out.select(
        F.col("key").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        head.alias("component_id"), F.coalesce(F.col("key") == head, F.lit(False)).alias("kept"),
    )


def _spread(tiles: DataFrame) -> DataFrame:
    """Tiles as single rows over many tasks: each is minutes of work and a few megabytes."""
    return tiles.repartition(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
