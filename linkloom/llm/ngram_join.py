"""Similarity join on word shingles: T-occurrence search with skipped long lists (DivideSkip).

Two texts link when their sets of five-word shingles have a Jaccard similarity of 0.75 or more.
Texts with equal sets form one class; classes are joined, and a class stands for its copies.

1. Sets. One pass over the texts gives each document its set (64-bit hashes), the class (hash of
   the set) and a sample of the set: the smallest ``n - T + l`` hashes, where ``T`` = 0.75 n is
   the least overlap any partner must have and ``l`` = n / 8, at least 40, at most ``T``. Linked
   classes share at least ``min(l, l')`` hashes of their samples, whatever the other hashes are.
2. Inverted lists over the samples. A list with one class is dropped. Each class skips its
   longest lists, one fewer than the least number it must share (``T`` - ``L`` = 1): a partner
   must still meet it in one of its short lists. Passages that many documents share are long
   lists and are skipped; a class without enough lists has no partner at all.
3. Search. Classes that meet in a short list are dealt into chunks of bounded volume and pairs of
   chunks into tiles. In a tile the full sets are indexed; each class merges its short lists by
   counting, takes those that occur often enough, and probes its long lists for them by binary
   search. The exact test is made on whole numbers. Classes that are connected already are not
   compared again, so a group of copies costs one comparison a member, not one a pair.
   First each chunk alone and with the first chunk of its group, then, only for lists whose
   classes are not all connected, the other pairs of chunks.
4. Components of the links found.

Every list that matters is searched; nothing is capped, sampled or cut. The volume of a tile is
bounded whatever the size of a group, and a frequent shingle is one list among many. Numpy works
inside the tasks; Spark deals out lists, sets and tiles.

Hashes of 64 bits stand for shingles and classes; two different sets of a corpus of a billion
collide with a chance of about 3 in 100. The lists of step 2 are shuffled by ``LIST_BITS`` bits of
a shingle's hash: lists that fall together there are searched together, and the exact test decides.

What is shuffled: one row of two numbers for each shingle of a sample, and the sets of classes that
meet others, each a fixed number of times; the other joins are made on the rows that are left.

Defined cases: null, empty and blank texts have no shingles and are alone; texts of fewer than
five words are one shingle; repeated rows and equal texts share a class; a null key counts as
larger than any other; an empty table gives no rows; other columns are ignored, and kept by
``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_texts
from linkloom.llm.components import components
from linkloom.operators.ordered import running_total
from linkloom.scratch import stage

WORDS = 5
PERCENT = 75
SHARE = 8  # the sample's surplus is one SHARE-th of the set
SURPLUS = 40  # or this, so that a line shared by short texts is skipped, too
CHUNK = 120_000  # shingles
PER_CLASS = 100  # added to each set's size, so a chunk has a bounded number of classes, too
LIST_BITS = 48
_MAX_BROADCAST_KEYS = 2_000_000
_LONG_RUN = 1 << 20

_U = np.uint64
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_CASED = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE = _CASED[_LOWER]
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_BLOCK = 1 << 20


def _powers(base: int, size: int = _BLOCK + 1) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers(dict):
    """The powers of a number. A task reckons them itself, they are not sent with its code."""

    def __missing__(self, base: int) -> np.ndarray:
        out = self[base] = _powers(base)
        return out

    def __reduce__(self):
        return _Powers, ()


_POWERS = _Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xA0761D6478BD642F)
    return x ^ (x >> _U(32))


def word_hashes(raw: bytes, cased: bool = False) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text, A-Z in lower case unless ``cased``."""
    value = _CASED if cased else _BYTE
    power, inverse = _POWERS[_STEP], _POWERS[_BACK]
    out = []
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > _BLOCK:  # cut after white space, or word by word if there is none
            piece = np.frombuffer(raw, np.uint8, _BLOCK, at)
            spaces = np.flatnonzero(_SPACE[piece])
            if len(spaces):
                end = at + int(spaces[-1]) + 1
            else:
                stop = next((k for k in range(at + _BLOCK, len(raw)) if _SPACE[raw[k]]), len(raw))
                total = 0
                for k in range(at, stop, _BLOCK):
                    part = np.frombuffer(raw, np.uint8, min(_BLOCK, stop - k), k)
                    total += int((value[part] * power[: len(part)]).sum()) * pow(_STEP, k - at, 1 << 64)
                out.append(_mix(np.array([total % (1 << 64)], np.uint64)))
                at = stop
                continue
        a = np.frombuffer(raw, np.uint8, end - at, at)
        edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[a], [True])).astype(np.int8)))
        begin, stop = edge[::2], edge[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[a] * power[: len(a)])))
        out.append(_mix((sums[stop] - sums[begin]) * inverse[begin]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of shingle hashes of a text, as signed numbers."""
    w = word_hashes((text or "").encode("utf-8", "surrogatepass"))
    if not len(w):
        return np.zeros(0, np.int64)
    k = min(WORDS, len(w))
    h = np.zeros(len(w) - k + 1, np.uint64)
    for j in range(k):
        h = _mix(h * _U(31) + w[j : len(w) - k + 1 + j])
    return np.unique(h.view(np.int64))


def _least_overlap(n: int) -> int:
    return -(-PERCENT * n // 100)


def _surplus(n: int) -> int:
    return max(1, min(_least_overlap(n), max(-(-n // SHARE), SURPLUS)))


def _class_of(h: np.ndarray) -> int:
    place = np.arange(1, len(h) + 1, dtype=np.uint64) * _U(_STEP)
    with np.errstate(over="ignore"):
        total = _mix(h.view(np.uint64) ^ _mix(place)).sum(dtype=np.uint64)
    return int(_mix(np.array([total + _U(len(h))], np.uint64)).view(np.int64)[0])


def _signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, cls, sample); a class repeated in a batch carries its sample once."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, classes, samples, seen = [], [], [], set()
            for t in batch.column(1):
                h = shingles(t.as_py())
                n = len(h)
                cls = _class_of(h) if n else None
                sizes.append(n)
                classes.append(cls)
                again = not n or cls in seen
                samples.append(h[:0] if again else h[: n - _least_overlap(n) + _surplus(n)])
                seen.add(cls)
            ends = np.cumsum([0, *map(len, samples)]).astype(np.int32)
            values = np.concatenate(samples) if samples else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                ],
                ["key", "n", "cls", "sample"],
            )

        return step

    return map_texts(docs, [key, text], f"key {kind}, n long, cls long, sample array<long>", make)


def _listed(signatures: DataFrame) -> DataFrame:
    """(h, cls): the inverted lists, one row for each shingle of a sample."""
    low = F.lit((1 << LIST_BITS) - 1)
    return signatures.select(F.explode("sample").alias("_h"), "cls").select(F.col("_h").bitwiseAND(low).alias("h"), "cls")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (h, cls) sorted by h and cls: those whose h has two classes or more, with the
    list's length. A list too long to hold counts as the longest."""

    def rows(h, c, df):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (h, c, df)], ["h", "cls", "df"])

    held = [np.zeros(0, np.int64)] * 2
    endless = None
    for batch in batches:
        h, c = (np.concatenate((a, b.to_numpy())) for a, b in zip(held, batch.columns))
        if not len(h):
            continue
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        h, c = h[first], c[first]
        if endless is not None:
            same = h == endless
            if same.any():
                yield rows(h[same], c[same], np.full(int(same.sum()), _LONG_RUN))
            h, c = h[~same], c[~same]
            if not len(h):
                held = [h, c]
                continue
            endless = None
        last = int(np.searchsorted(h, h[-1]))
        starts = np.flatnonzero(np.concatenate(([True], h[1:last] != h[: last - 1]))) if last else np.zeros(0, int)
        df = np.repeat(np.diff(np.append(starts, last)), np.diff(np.append(starts, last)))
        some = df > 1
        if some.any():
            yield rows(h[:last][some], c[:last][some], np.minimum(df[some], _LONG_RUN))
        held = [h[last:], c[last:]]
        if len(held[0]) >= _LONG_RUN:
            endless = h[-1]
            yield rows(*held, np.full(len(held[0]), _LONG_RUN))
            held = [np.zeros(0, np.int64)] * 2
    if len(held[0]) > 1:
        yield rows(*held, np.full(len(held[0]), len(held[0])))


class Tile:
    """Full sets of some classes, indexed by shingle."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        _, tokens, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.begin = np.concatenate(([0], np.cumsum(df)))
        order = np.argsort(tokens, kind="stable")
        self.owners = owner[order]
        self.address = tokens[order].astype(np.int64) * len(sets) + self.owners
        self.tokens = np.split(tokens, np.cumsum(self.sizes)[:-1])
        self.df = df
        self.count = len(sets)

    def candidates(self, q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sets that occur often enough on the short lists of ``q``, how often, and its long lists."""
        n = int(self.sizes[q])
        least = _least_overlap(n)
        lists = self.tokens[q][self.df[self.tokens[q]] > 1]
        if len(lists) < least:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), lists
        lists = lists[np.argsort(self.df[lists], kind="stable")]
        longest = int(self.df[lists[-1]])
        skip = min(least - 1, int(least / (0.0085 * np.log2(longest + 1) + 1)))
        short, long = lists[: len(lists) - skip], lists[len(lists) - skip :]
        sizes = self.df[short]
        at = np.repeat(self.begin[short] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        counts = np.bincount(self.owners[at], minlength=self.count)
        found = np.flatnonzero(counts >= least - skip)
        return found, counts[found], long

    def probe(self, long: np.ndarray, d: int) -> int:
        """On how many of the long lists a set stands, by binary search."""
        want = long.astype(np.int64) * self.count + d
        at = np.searchsorted(self.address, want)
        return int((self.address[np.minimum(at, len(self.address) - 1)] == want).sum())


def links(sets: list[np.ndarray], groups: list[int] | None = None, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets that are not in the same group yet.

    With ``sides``, only sets of different sides are compared.
    """
    tile = Tile(sets)
    parent = list(range(len(sets)))
    if groups is not None:
        head: dict[int, int] = {}
        parent = [head.setdefault(g, k) for k, g in enumerate(groups)]

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    out = []
    for q in range(len(sets)):
        found, counts, long = tile.candidates(q)
        n = int(tile.sizes[q])
        m = tile.sizes[found]
        fits = (found < q) & (100 * np.minimum(m, n) >= PERCENT * np.maximum(m, n))
        for d, count in zip(found[fits].tolist(), counts[fits].tolist()):
            if sides is not None and sides[d] == sides[q]:
                continue
            a, b = root(q), root(d)
            if a == b:
                continue
            common = count + tile.probe(long, d)
            if 100 * common >= PERCENT * (n + int(tile.sizes[d]) - common):
                parent[max(a, b)] = min(a, b)
                out.append((q, d))
    return out


def _search(table: pa.Table) -> pa.Table:
    """Links of one tile: columns cls, set and, in the second round, component and side."""
    table = table.sort_by("cls").combine_chunks()
    cls = table["cls"].to_pylist()
    sets = [np.frombuffer(s.as_buffer(), np.int64) for s in table["set"]]
    two = "side" in table.column_names
    found = links(sets, *((table["component"].to_pylist(), table["side"].to_pylist()) if two else ()))
    return pa.table(
        {"u": pa.array([cls[q] for q, _ in found], pa.int64()), "v": pa.array([cls[d] for _, d in found], pa.int64())}
    )


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(cls, leader, chunk, set) of the wanted classes, from the texts of one document each; a class
    comes again if rows with its key are repeated."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            own, sets = [], []
            for k, (t, cls) in enumerate(zip(batch.column(0), batch.column(1).to_pylist())):
                h = shingles(t.as_py())
                if len(h) and _class_of(h) == cls:  # else another row with the same key
                    own.append(k)
                    sets.append(h.tobytes())
            at = pa.array(own, pa.int64())
            return pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in (1, 2, 3)), pa.array(sets, pa.binary())],
                ["cls", "leader", "chunk", "set"],
            )

        return step

    side = F.broadcast(wanted) if wanted.count() <= _MAX_BROADCAST_KEYS else wanted
    rows = docs.select(F.col(key).alias("_doc"), F.col(text).alias("_text")).join(
        side, F.col("_doc").eqNullSafe(F.col("key"))
    )
    return map_texts(
        rows, ["_text", "cls", "leader", "chunk"], "cls long, leader long, chunk long, set binary", make
    )


def _chunked(members: DataFrame) -> DataFrame:
    """``members`` (cls, n, leader) with ``chunk``, the number of a part of bounded volume."""
    volume = F.col("n") + PER_CLASS
    ranked = running_total(members, ["leader"], ["n", "cls"], volume, "_before")
    return ranked.withColumn("chunk", F.expr(f"_before div {CHUNK}")).drop("_before")


def join_classes(docs: DataFrame, signatures: DataFrame, key: str, text: str) -> DataFrame:
    """(node, component) of the classes that are linked with another."""
    shared = _listed(signatures).repartition("h").sortWithinPartitions("h", "cls").mapInArrow(
        _shared, "h long, cls long, df long"
    )
    sizes = signatures.filter("n > 0").groupBy("cls").agg(F.max("n").alias("n"))
    # Dealt by class before they are collected: plain rows take less room than begun lists.
    per_class = shared.repartition("cls").groupBy("cls").agg(F.collect_list(F.struct("df", "h")).alias("lists"))
    per_class = per_class.join(sizes, "cls")
    # The surplus of the smallest partner there can be.
    least = F.expr(f"(n * {PERCENT} + 99) div 100")
    of_least = F.expr(f"((n * {PERCENT} + 99) div 100 * {PERCENT} + 99) div 100")
    surplus = F.greatest(F.ceil(least / SHARE), F.lit(SURPLUS))
    need = F.greatest(F.lit(1), F.least(of_least, surplus)).cast("int")
    short = F.slice(F.sort_array("lists"), F.lit(1), F.size("lists") - need + 1)
    # One row a class: what is joined by class later does not carry it with each list.
    kept = per_class.filter(F.size("lists") >= need).select(
        "cls", "n", F.transform(short, lambda x: x["h"]).alias("lists")
    )
    kept = stage(kept, "short-lists")
    listed = kept.select("cls", "n", F.explode("lists").alias("h"))
    hubs = listed.groupBy("h").agg(F.min("cls").alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    led = listed.join(hubs, "h").groupBy("cls", "n").agg(F.min("hub").alias("leader"))
    members = stage(_chunked(stage(led, "led")), "members")

    keys = signatures.groupBy("cls").agg(F.min("key").alias("key"))
    wanted = stage(keys.join(members, "cls").select("key", "cls", "leader", "chunk"), "wanted")
    sets = stage(_sets(docs, wanted, key, text), "sets")
    if sets.count() > wanted.count():
        sets = stage(sets.dropDuplicates(["cls"]), "sets")

    last = members.groupBy("leader").agg(F.max("chunk").alias("last")).filter("last > 0")
    # ``last`` has at most a row for each ``CHUNK`` of all shingles.
    spread = sets.filter("chunk = 0").join(F.broadcast(last), "leader").select(
        "cls", "leader", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("chunk"), "set"
    )
    first = sets.unionByName(spread)
    edges = stage(first.groupBy("leader", "chunk").applyInArrow(_search, "u long, v long"), "links")

    joined = stage(components(edges), "joined")
    now = members.join(joined, members["cls"] == joined["node"], "left").select(
        "cls", "leader", "chunk", F.coalesce("component", "cls").alias("component")
    )
    now = stage(now, "now")
    # Only lists whose classes are not all connected go on. Both uses of ``lists`` share one shuffle.
    lists = kept.select("cls", "lists").join(now, "cls").select(
        F.explode("lists").alias("h"), "leader", "chunk", "component"
    )
    mixed = lists.groupBy("h").agg(F.min("component").alias("_a"), F.max("component").alias("_b"))
    mixed = mixed.filter("_a <> _b").select("h")
    apart = lists.join(mixed, "h", "left_semi").groupBy("h", "leader", "chunk").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    apart = stage(apart, "chunk-lists")
    a, b = apart.alias("a"), apart.alias("b")
    later = F.expr("(a.leader < b.leader OR (a.leader = b.leader AND a.chunk < b.chunk))")
    done = F.expr("a.leader = b.leader AND a.chunk = 0")
    settled = F.expr("a.low = a.high AND b.low = b.high AND a.low = b.low")
    pairs = a.join(b, F.expr("a.h = b.h") & later & ~done & ~settled).select(
        F.expr("a.leader").alias("l1"), F.expr("a.chunk").alias("c1"),
        F.expr("b.leader").alias("l2"), F.expr("b.chunk").alias("c2"),
    ).distinct()
    pairs = stage(pairs, "tiles")
    tile = ["l1", "c1", "l2", "c2"]
    rows = None
    for side in (1, 2):
        own = [F.col("leader") == F.col(f"l{side}"), F.col("chunk") == F.col(f"c{side}")]
        part = pairs.join(now, own).select(*tile, "cls", "component", F.lit(side).alias("side"))
        rows = part if rows is None else rows.unionByName(part)
    rows = stage(rows, "tile-rows")
    sets = sets.select("cls", "set")
    few = stage(rows.select("cls").distinct(), "tile-classes")
    if few.count() <= _MAX_BROADCAST_KEYS:  # the other sets are not shuffled
        sets = sets.join(F.broadcast(few), "cls", "left_semi")
    more = rows.join(sets, "cls").groupBy(*tile).applyInArrow(_search, "u long, v long")
    more = stage(more, "more-links")
    return components(joined.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, ``n_shingles`` and ``component_id``, the smallest key linked."""
    signatures = stage(_signatures(docs, key, text), "signatures")
    linked = join_classes(docs, signatures, key, text)
    classes = signatures.filter("n > 0").groupBy("cls").agg(F.min("key").alias("least"))
    grouped = classes.join(linked, classes["cls"] == linked["node"], "left").select(
        "cls", "least", F.coalesce("component", "cls").alias("grp")
    )
    grouped = stage(grouped, "groups")
    heads = grouped.groupBy("grp").agg(F.min("least").alias("head"))
    named = grouped.join(heads, "grp").select(F.col("cls").alias("_cls"), "head")
    rows = signatures.select("key", "n", "cls")
    out = rows.join(named, F.col("cls") == F.col("_cls"), "left")
    alone = F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("head"))
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), alone.alias("component_id"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest key of their group, one for each group."""
    own = F.col(key).eqNullSafe(F.col("component_id"))
    keys = join(docs, key, text).groupBy(F.col(key).alias("_key")).agg(
        F.max(own).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    keys = stage(keys, "keys")
    rest = keys.filter("NOT _first").select("_key")
    if rest.count() <= _MAX_BROADCAST_KEYS:  # the texts are not shuffled
        rest = F.broadcast(rest)
    out = docs.join(rest, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    repeated = keys.filter("_rows > 1").limit(1).count()
    return out.dropDuplicates([key, text]) if repeated else out
