"""Language ID, hard negatives and spelling variants: brute force, SQL and awkward rows."""

import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from linkloom.llm import hard_negatives, language_id, queries, spelling

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

DOCS = "doc_id long, text string, lang string, source string, word string, n string"
VECS = "vec_id long, embedding array<float>, label int, q string, rank string"


# ---------------------------------------------------------------- spelling variants (op13)


def _near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def brute_variants(rows):
    """word -> (form, root, n, n_near, form_n), straight from the contract, all pairs compared."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 97 == 0:
                cut = h % len(run)
                run = run[:cut] + run[cut + 1 :]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in vocab.items():
        near = [v for v in vocab if _near(w, v)]
        best = min(near, key=lambda v: (-vocab[v], v)) if near else None
        form = best if best is not None and vocab[best] >= 2 * n else None
        out[w] = [form, None, n, len(near), vocab[form] if form else None]
    for w, rec in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rec[1] = root
    return {w: tuple(r) for w, r in out.items()}


def _collect_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_equals_brute_force_on_awkward_rows(spark):
    base = ["colour " * 3, "color " * 7, "colours " * 2, "kolor " * 16, "Straße strasse STRASSE " * 3]
    rows = [(i, t, "en", "s", "x", "y") for i, t in enumerate(base)]
    rows += [(10, None, None, None, None, None), (11, "", "en", "s", "", ""), (12, "123 !!", "en", "s", "", "")]
    rows += [(13, "colour color " * 2, "en", "s", "w", "n")] * 2  # repeated rows count twice
    rows += [(14, "tree" * 5000 + " treex treex treex", "en", "s", "", "")]  # one very long run
    rows += [(15, "aaaaa aaaab aaaac " * 4 + "aaaab " * 4, "en", "s", "", "")]  # ties by code point
    df = spark.createDataFrame(rows, DOCS)
    got = _collect_variants(spelling.group_variants(df))
    assert got == brute_variants([(r[0], r[1]) for r in rows])
    assert got["color"][0] is None and got["kolor"][0] is None
    assert got["colour"][1] == got["colour"][0] or got["colour"][0] is None


def test_spelling_root_follows_chains(spark):
    rows = [(1, "abcde " * 3 + "abcdf " * 6 + "abcdg " * 12 + "abcdh " * 24, "en", "s", "", "")]
    got = _collect_variants(spelling.group_variants(spark.createDataFrame(rows, DOCS)))
    assert got == brute_variants([(1, rows[0][1])])
    assert all(rec[1] == "abcdh" for rec in got.values())


def test_spelling_empty_table(spark):
    assert spelling.group_variants(spark.createDataFrame([], DOCS)).count() == 0


def test_spelling_query_equals_brute_force(spark):
    got = _collect_variants(queries.op13_spelling_variants(spark, FOLDER))
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert got == brute_variants(rows)
    assert any(rec[0] for rec in got.values())


def test_spelling_reduction_keeps_every_near_pair():
    """Two words one edit apart have reduced forms at most one edit apart."""
    rng = np.random.default_rng(3)
    letters = spelling.LETTERS
    table = str.maketrans(letters, spelling.REDUCED)
    for _ in range(2000):
        w = "".join(rng.choice(list(letters), size=rng.integers(5, 9)))
        i = int(rng.integers(0, len(w)))
        v = [w[:i] + w[i + 1 :], w[:i] + rng.choice(list(letters)) + w[i + 1 :], w[:i] + rng.choice(list(letters)) + w[i:]]
        for x in v:
            a, b = w.translate(table), x.translate(table)
            assert a == b or _near(a, b)


# ---------------------------------------------------------------- hard negatives (op12)


def _duck(con_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", con_rows)
    return sorted(tuple(r) for r in con.execute(hard_negatives.sql()).fetchall())


def test_hard_negatives_equal_sql_on_the_table(spark):
    got = sorted(tuple(r) for r in queries.op12_hard_negatives(spark, FOLDER).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    want = sorted(tuple(r) for r in con.execute(hard_negatives.sql()).fetchall())
    assert got == want and got


def test_hard_negatives_awkward_rows(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        vec = [float(x) for x in rng.normal(0, 0.3, 8)]
        rows.append((i, vec, int(i % 3)))
    rows += [(700, None, 1), (701, [0.1] * 8, None), (702, [float("nan")] + [0.1] * 7, 1)]
    rows += [(703, [float("inf")] + [0.1] * 7, 1), (704, [None] + [0.1] * 7, 1), (705, [], 1)]
    rows += [(706, [0.2] * 4, 1), (None, [0.3] * 8, 1), (707, [0.5] * 8, 2), (707, [0.5] * 8, 2)]
    rows += [(800, [0.25] * 8, 1), (900, [-0.5] * 8, 0), (1000, [0.0] * 8, 2)]
    rows += [(1100 + k, [0.25] * 8, 1) for k in range(12)]  # ties broken by vec_id
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECS)
    got = sorted(tuple(r) for r in hard_negatives.mine(df).collect())
    assert got == _duck(rows)
    assert {r[0] for r in got} >= {0, 100, 200, 800}


def _rowwise(rows):
    """The contract in plain Python, rows told apart by their place."""
    q = [(i, l if i % 7 else (l + 1) % 10, [math.floor(256 * x) for x in v]) for i, v, l in rows]
    out = []
    for k, (own, label, a) in enumerate(q):
        if own % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i, lab) for j, (i, lab, v) in enumerate(q) if j != k]
        scored.sort(key=lambda t: t[:2])
        for ps, pid in [(-s, i) for s, i, lab in scored if lab == label][:5]:
            fit = [(-s, i) for s, i, lab in scored if lab != label and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(own, pid, r, nid, ps, ns) for r, (ns, nid) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [0.3, 250_000.0])  # the larger one leaves 64 bits in percents
def test_hard_negatives_repeated_keys_are_rows_of_their_own(spark, monkeypatch, size):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 100)  # twins fall into several tiles
    rng = np.random.default_rng(3)
    vec = lambda: [float(np.float32(x)) for x in np.clip(rng.normal(0.3, 1, 64), -1, 1) * size]
    rows = [(i, vec(), i % 3) for i in range(250)]
    rows += [r for r in rows if r[0] % 2 == 0]  # rows that come twice: anchors, positives, negatives
    rows += [(100, vec(), 2), (100, vec(), 1), (33, vec(), 0)]  # the same key on other rows
    got = sorted(tuple(r) for r in hard_negatives.mine(spark.createDataFrame([(*r, "x", "y") for r in rows], VECS)).collect())
    assert got == _rowwise(rows)
    assert any(r[0] == r[1] for r in got)  # a twin is another row


def test_hard_negatives_scan_equals_full_scores():
    rng = np.random.default_rng(11)
    import pandas as pd

    q = rng.integers(-300, 300, (500, 40))
    rows = pd.DataFrame({"vec_id": np.arange(500), "label": rng.integers(0, 2, 500), "q": list(q)})
    block = hard_negatives._Block(rows, 40)
    for anchor in q[:20]:
        full = q @ anchor
        for label in (0, 1):
            got = hard_negatives._positives(anchor, label, -1, block)
            same = [i for i in range(500) if rows.label[i] == label]
            want = sorted(((-full[i], i) for i in same))[:5]
            assert got == [(i, -s) for s, i in want]
            ps = max(int(full[same].max()), 1)
            got = hard_negatives._negatives(anchor, label, -1, ps, block)
            other = [i for i in range(500) if rows.label[i] != label and 30 * ps <= 100 * full[i] <= 90 * ps]
            want = sorted(((-full[i], i) for i in other))[:10]
            assert got == [(i, -s) for s, i in want]


def test_hard_negatives_empty(spark):
    assert hard_negatives.mine(spark.createDataFrame([], VECS)).count() == 0


# ---------------------------------------------------------------- language id (op11)


def test_language_id_learns_and_holds_out(spark):
    out = queries.op11_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    assert len(out) == len(truth)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0.0 <= r.score <= 1.0
    held = [r for r in out if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.95


def test_language_id_awkward_rows(spark):
    en = "the quick brown fox jumps over the lazy dog and then it runs away from the farmer " * 3
    de = "der schnelle braune fuchs springt über den faulen hund und läuft dann weg vom bauern " * 3
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de", "s", "w", "n") for i in range(1, 40)]
    rows += [(100, None, "en", "s", "", ""), (101, "", "de", "s", "", ""), (102, "123 ... !!", "en", "s", "", "")]
    rows += [(103, "xyz " + en, None, "s", "", ""), (104, "x" * 200_000, "en", "s", "", "")]
    rows += [(None, en, "en", "s", "", "")]
    df = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    assert len(got) == len(rows)
    for i in (100, 101, 102):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert got[103].lang_pred == "en" and got[2].lang_pred == "de"
    assert got[None].held_out is False


def test_language_id_without_training_rows(spark):
    df = spark.createDataFrame([(2, "hello world", None, "s", "", "")], DOCS)
    assert [tuple(r) for r in language_id.identify(df).collect()] == [(2, False, "und", 0.0)]


def test_profile_is_the_bound_bundle():
    """The profile equals a direct sum of rotated, multiplied letter vectors."""
    p = language_id.Profiler(64)
    text = "Ab, ab! Über"
    got = p.profile(text)
    framed = " ab ab über "
    vec = lambda ch: np.random.default_rng([language_id.SEED, ord(ch)]).integers(0, 2, 64, dtype=np.int8) * 2 - 1
    want = sum(np.roll(vec(a), 2) * np.roll(vec(b), 1) * vec(c) for a, b, c in zip(framed, framed[1:], framed[2:]))
    assert np.array_equal(got, want.astype(float))
    assert p.profile("42 !") is None and p.profile(None) is None
