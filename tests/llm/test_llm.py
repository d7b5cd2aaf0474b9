"""The training-data operators: brute force, SQL, round trips, and awkward rows."""

import hashlib
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from linkloom import scratch
from linkloom.llm import (
    components,
    hnsw_dedup,
    main_text,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_cnn,
    quality_rules,
    queries,
    sharding,
    tokens,
)

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, slot string, n_words string"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def odd_docs(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi"
    rows = [
        (1, None, None, None, None, "x", "y"),
        (2, "", "en", "a", 0, None, None),
        (3, " \n\t ", "en", "a", 4, None, None),
        (4, base, "en", "a", 10, None, None),
        (5, base, "en", "a", 10, None, None),
        (5, base, "en", "a", 10, None, None),
        (None, base + " omega", None, "b", 10, None, None),
        (6, "two words", "de", "b", 9, None, None),
        (7, "Two  WORDS", "de", "b", 9, None, None),
        (8, ("the quick brown fox " * 5000).strip(), "en", "b", 1, None, None),
        (9, "x" * 3000, "en", None, 1, None, None),
        (10, "mail me: a.b@c.de now +1 (578) 555-6437, 10.0.0.1 or 4111 1111 1111 1111.", "en", "c", 1, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, FOLDER)
    want = duck.execute(queries.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def _links(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    head = {i: i for i in sets}

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = root(a), root(b)
                    head[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_ngram_join_against_all_pairs(spark, duck):
    want = _links(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    got = queries.op5_ngram_join(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(want)


def test_ngram_join_in_small_tiles(spark, monkeypatch):
    """A group of near copies and a passage that others share, dealt over many chunks."""
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(400)]
    base = [words[k] for k in rng.integers(0, 400, 120)]
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.integers(0, 120, int(rng.integers(1, 7))):
            own[k] = f"new{rng.integers(1000)}"
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join([words[k] for k in rng.integers(0, 400, 40)] + base[:70])) for i in range(40)]
    rows += [(200 + i, " ".join(base[i:])) for i in range(40)]
    want = _links(rows)
    monkeypatch.setattr(ngram_join, "CHUNK", 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    assert got == want


@pytest.mark.parametrize("most", [ngram_join._MAX_BROADCAST_KEYS, 0])
def test_ngram_join_shuffles_narrow_lists_and_no_other_sets(spark, monkeypatch, most):
    """Lists are two numbers a shingle; a set comes once a class though rows with its key repeat,
    and the second round reads the same sets whether its classes are broadcast or not."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 60, 60)) for _ in range(12)]
    rows = [(i, t if i < 12 else " ".join(t.split()[: 60 - i % 5])) for i, t in enumerate(texts * 4)]
    docs = spark.createDataFrame([*rows, *rows[::3], *rows[:6]], "doc_id long, text string")
    signatures = ngram_join._signatures(docs, "doc_id", "text")
    lists = ngram_join._listed(signatures)
    assert lists.columns == ["h", "cls"]
    assert lists.count() == signatures.selectExpr("sum(size(sample))").first()[0]
    assert 0 <= lists.agg({"h": "min"}).first()[0] and lists.agg({"h": "max"}).first()[0] < 1 << 48
    monkeypatch.setattr(ngram_join, "_MAX_BROADCAST_KEYS", most)
    monkeypatch.setattr(ngram_join, "CHUNK", 300)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    assert got == _links(rows)


def test_ngram_join_deals_sets_once(spark, monkeypatch):
    """Sets know their chunk, so the search shuffles them once; lists are kept one row a class."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 60, 60)) for _ in range(6)]
    rows = [(10 * i + k, " ".join(t.split()[: 60 - k])) for i, t in enumerate(texts) for k in range(6)]
    staged = {}

    def spy(df, label):
        staged[label] = df._jdf.queryExecution().executedPlan().toString()
        out = scratch.stage(df, label)
        if label == "short-lists":
            staged["rows"] = (out.count(), out.select("cls").distinct().count())
        return out

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        monkeypatch.setattr(ngram_join, "stage", spy)
        monkeypatch.setattr(ngram_join, "CHUNK", 300)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == _links(rows)
    assert "SortMergeJoin" not in staged["links"]
    assert staged["rows"][0] == staged["rows"][1] > 0


@pytest.mark.parametrize("most", [ngram_join._MAX_BROADCAST_KEYS, 0])
def test_keep_first_shuffles_no_texts(spark, monkeypatch, most):
    """The keys that go are broadcast, beyond the bound joined; repeated and null keys as before."""
    words = " ".join(f"w{k}" for k in range(40))
    rows = [(5, words), (2, words), (7, words + " end"), (9, "quite another text of some words"), (9, words), (9, "x"), (None, "y"), (None, words), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "_MAX_BROADCAST_KEYS", most)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept = ngram_join.keep_first(docs.filter("doc_id <> 9 AND doc_id <> 3"))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == (most == 0)
        assert [tuple(r) for r in kept.collect()] == [(2, words)]
        got = ngram_join.keep_first(docs).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = [(2, words), (3, None), (9, "quite another text of some words"), (9, words), (9, "x"), (None, "y")]
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want + [(None, words)]), key=str)


def test_ngram_join_odd_rows(spark):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.join(odd_docs(spark)).collect())
    assert got[:4] == [(0, 11, 4), (1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [g for g in got if g[0] in (4, 5, 6, 7)] == [(4, 10, 4), (5, 10, 4), (5, 10, 4), (6, 1, 6), (7, 1, 6)]
    kept = ngram_join.keep_first(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 6, 8, 9, 10]
    assert ngram_join.join(no_docs(spark)).count() == 0


def test_page_tokens_hashed_on_bytes():
    """One number a token, told apart by case, for pages without text, too; cut sums each sentence."""
    pages = [["Über den Fluß", "a A a"], [], ["x" * 300], ["a\u2003b c"], ["A"]]
    sizes, numbers = main_text._hashed(pages)
    tokens = [w for texts in pages for w in " ".join(texts).split(" ") if texts]
    assert sizes.tolist() == [6, 0, 1, 2, 1] and len(numbers) == len(tokens)
    assert len(set(zip(tokens, numbers.tolist()))) == len(set(tokens)) == len(set(numbers.tolist()))
    assert [len(x) for x in main_text._hashed([[], []])] == [2, 0]
    covered = np.array([1] * 4 + [0] * 3 + [1, 0, 0, 0, 0], bool)
    assert main_text.cut(["One two three four.", "Five six seven", "a b c d e"], covered) == "Five six seven a b c d e"


def test_long_texts_hash_like_short_ones(monkeypatch):
    text = ("Überall ist Text\t" * 300 + "z" * 2000 + " end ").encode()
    want = ngram_join.word_hashes(text)
    monkeypatch.setattr(ngram_join, "_BLOCK", 64)
    assert np.array_equal(ngram_join.word_hashes(text), want)


def test_components(spark):
    pairs = [(k, k + 1) for k in range(100, 160)] + [(7, 9), (9, 8), (5, 5)] + [(1000, k) for k in range(1001, 1100)]
    got = components.components(spark.createDataFrame(pairs, "u long, v long")).collect()
    groups = defaultdict(set)
    for r in got:
        groups[r.component].add(r.node)
    assert {k: len(v) for k, v in groups.items()} == {7: 3, 100: 61, 1000: 100}
    assert len(got) == 164


def test_hnsw_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16))
    x[600:1200] = x[0] + rng.normal(size=(600, 16)) * 0.15
    x[1200:1240] = x[1]
    label = rng.integers(0, 2, 1500)
    label[1200:1240] = label[1]
    rows = [(int(i), [float(v) for v in x[i]], int(label[i])) for i in range(1500)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [1.0, None] + [0.0] * 14, 1), (2003, [float("nan")] * 16, 1)]
    rows += [(2004, rows[0][1], None), (2005, [], 1), (2006, rows[0][1][:4], int(label[0]))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in hnsw_dedup.join(frame).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    assert len(got) == len(rows)
    assert sum(got[i].n_links for i in range(1500)) >= 0.98 * near.sum() > 0
    assert all(got[i].n_links <= near[i].sum() for i in range(1500))
    for i in range(1200, 1240):
        assert got[i].component_id == min(got[1].component_id, 1) and not got[i].kept
    assert all(got[k].n_links == 0 and got[k].kept for k in range(2000, 2007))
    assert hnsw_dedup.join(frame.filter("vec_id < 0")).count() == 0


def test_hnsw_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw_dedup, "SHARD", 150)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(60, 8))
    x = np.repeat(centre, 8, 0) + rng.normal(size=(480, 8)) * 0.05
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(480)]
    got = {r.vec_id: r for r in hnsw_dedup.join(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    assert sum(r.n_links for r in got.values()) >= 0.98 * near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in range(480))


def test_pii_against_plain_patterns(spark, duck):
    want = [pii.digest_brute(i, t) for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()]
    got = queries.op7_pii(spark, FOLDER).drop("spans").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_pii_odd_texts(spark):
    odd = ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "@x.y", "++1 234 567 8901", "9" * 5000, "a" * 5000 + "@", "4111-1111 11111111 x 300.1.1.1"]
    for t in odd:
        own = sorted((s[0], pii.BASE.index(s[2]), s[1]) for s in pii.spans(t) if s[2] in pii.BASE)
        line = ",".join(f"{pii.BASE[k]}:{a}:{b}" for a, k, b in own)
        assert hashlib.sha256(line.encode()).hexdigest() == pii.digest_brute(0, t)[-1]
    docs = odd_docs(spark)
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.count() == 12
    text = masked.filter("doc_id = 10").first().text
    assert text == "mail me: [EMAIL] now [PHONE], [IP] or [CARD]."
    assert masked.filter("doc_id = 10").first().n_chars == len(text)
    assert masked.filter("doc_id = 1").first().text is None
    assert pii.spans("IBAN GB82 WEST 1234 5698 7654 32 ok")[0][2] == "iban"
    assert not pii.spans("DE89370400440532013001 and 12345678")
    assert pii.digest(no_docs(spark)).count() == 0


def test_token_counts_and_splices(spark, duck):
    ranks = tokens.path_of("byte_bpe_50k.tiktoken")
    for name, kind, fast in (
        ("byte_bpe_50k.json", "byte_bpe", None),
        ("byte_bpe_50k.json", "byte_bpe", ranks),
        ("word_bpe_49k.json", "word_bpe", None),
    ):
        own = tokens.Encoder(tokens.path_of(name), kind, memo=500, ranks=fast)
        texts = [t for (t,) in duck.execute("SELECT text FROM documents ORDER BY doc_id LIMIT 40").fetchall()]
        texts += ["", " ", "a  b\n\n c\t ", "x<|endoftext|>y  <|endoftext|> z <|startoftext|>", "é I'll \x1c\x85b", "x" * 900, "日本　語 テ"]
        for t, ids in zip(texts, own.encode_all(texts)):
            want = own.library.encode(t, add_special_tokens=False).ids
            assert list(ids) == want
            for chunk, overlap in ((40, 8), (500, 30)):
                assert list(own.encode_long(t, chunk, overlap)) == want
    got = tokens.count_tokens(odd_docs(spark), tokens.path_of("word_bpe_49k.json"), "word_bpe").collect()
    assert len(got) == 12
    assert {(r.n_bytes, r.n_tokens) for r in got if r.doc_id in (1, 2)} == {(0, 0)}
    assert [(r.n_tokens, r.over_limit) for r in got if r.doc_id == 8] == [(20_000, True)]
    assert tokens.count_tokens(no_docs(spark), tokens.path_of("word_bpe_49k.json"), "word_bpe").count() == 0


def _check_packing(rows, library, texts, size=2048):
    ids = {k: [*library.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts.items()}
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32 and len(own) == r.length
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return sequences, pieces, ids


def test_packing(spark, duck):
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    library = tokens.Encoder(tokens.path_of("byte_bpe_50k.json"), "byte_bpe").library
    sequences, pieces, ids = _check_packing(queries.op8_packing(spark, FOLDER).collect(), library, texts)
    assert set(pieces) == set(texts)
    for k, own in pieces.items():
        own.sort(key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids[k]) and all(r.length == 2048 for r in own[1:])
    least = -(-sum(map(len, ids.values())) // 2048)
    assert len(sequences) <= 1.02 * least + 1
    rows = packing.pack(odd_docs(spark), tokens.path_of("byte_bpe_50k.json")).collect()
    assert {r.length for r in rows if r.doc_id in (1, 2)} == {1}
    assert sum(r.doc_id == 5 for r in rows) == 2
    assert packing.pack(no_docs(spark), tokens.path_of("byte_bpe_50k.json")).count() == 0


def test_best_fit_places_every_rank_once():
    rng = np.random.default_rng(2)
    counts = Counter(rng.integers(1, 100, 3000).tolist())
    matches, opened = packing.best_fit(dict(counts), 100)
    filled, seen = defaultdict(list), Counter()
    for length, low, high, first, offset in matches:
        seen[length] += high - low
        for k in range(high - low):
            filled[first + k].append((offset, length))
    assert seen == counts and len(filled) == opened
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 100


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 20_000])
def test_sharding(spark, bucket_bytes):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sharding.shuffle_into_shards(docs, bucket_bytes=bucket_bytes).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(slots) == 8
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.slot, r.shard))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.3


def test_sharding_odd_rows_and_files(spark, tmp_path):
    out = sharding.shuffle_into_shards(odd_docs(spark))
    rows = out.collect()
    assert len(rows) == 12 and dict(out.dtypes)["slot"] == "bigint"
    assert sharding.shuffle_into_shards(no_docs(spark)).count() == 0
    sharding.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 12
    digest = sharding.digest(odd_docs(spark)).collect()
    assert {(r["size"], r.text_crc32) for r in digest if r.doc_id in (1, 2)} == {(1, 0)}


def test_mixing_meets_the_marginals(spark):
    cells = [(s, g, t, 10 * (1 + a * b + c)) for a, s in enumerate("xyz") for b, g in enumerate("pq") for c, t in enumerate("uv")]
    frame = spark.createDataFrame(cells, "_source string, _language string, _topic string, _tokens long")
    given = {"source": {"x": 0.5}, "language": {"p": 0.3, "q": 0.7}}
    raked = mixing.rake(frame.coalesce(1), 30, given)
    share = {r._source: r.s for r in raked.groupBy("_source").agg(F.sum("_share").alias("s")).collect()}
    assert abs(share["x"] - 0.5) < 1e-6 and abs(sum(share.values()) - 1) < 1e-9
    language = {r._language: r.s for r in raked.groupBy("_language").agg(F.sum("_share").alias("s")).collect()}
    assert abs(language["q"] - 0.7) < 1e-6
    done = mixing.calibrate(raked, 0.6).collect()
    assert all(0 < r._probability <= 1 for r in done)
    expected = sum(r._probability * r._tokens for r in done)
    assert abs(expected - 0.6 * sum(c[3] for c in cells)) < 1e-6


def test_mixing_odd_rows(spark):
    got = mixing.mix(odd_docs(spark), keep=1.0)
    assert got.count() == 12
    assert "text" in got.columns and got.filter("doc_id = 1").first().language == "unknown"
    assert mixing.mix(no_docs(spark)).count() == 0


def test_quality_rules_odd_rows(spark):
    rows = quality_rules.judge(odd_docs(spark)).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows}
    assert by[1].failed == ["few_words"] and by[1].n_words == 0 and not by[1].kept
    assert by[8].n_repeat_words == 20_000 and by[8].base_failed
    assert quality_rules.keep_good(odd_docs(spark)).columns == odd_docs(spark).columns
    assert quality_rules.judge(no_docs(spark)).count() == 0


def test_classifier_on_held_out_rows(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = queries.op3_quality_cnn(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9 and np.mean([s >= 0.3 for s in good]) > 0.95


def test_classifier_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (8, None), (8, 0)], "doc_id long, quality int")
    model = quality_cnn.learn(odd_docs(spark), labels)
    got = quality_cnn.score(odd_docs(spark), model).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert quality_cnn.score(no_docs(spark), model).count() == 0


def test_chunks_cover_the_whole_text():
    tables = np.zeros((quality_cnn.WIDTH, 256, quality_cnn.FILTERS), np.float32)
    tables[0, ord("#")] = 1
    one = np.ones(quality_cnn.FILTERS)
    model = quality_cnn.Model(tables, one * 0, one * 0, one, -5.0)
    for n in (7, 1000, 1024, 5000, 61_440, 61_441, 200_000):
        for at in (0, n // 4 * 2, (n - quality_cnn.WIDTH) // 2 * 2):
            raw = bytearray(b"a" * n)
            raw[at] = ord("#")
            assert model.score(bytes(raw)) > 0.9, (n, at)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><div id="top-header">Site name</div>
<ul class="menu"><li><a href="/a">First</a><li><a href="/b">Second</a></ul>
<article><h1>Head &amp; tail</h1><p>One <b>bold</b>er word.<p>Next<br>line &#233;</p>
<aside>By the way</aside><form>Your name</form><div class="comments"><p>Nice</p></div></article>
<script>var a = "<p>no</p>";</script><footer>End</footer></body>"""


def test_main_text_of_markup():
    page = main_text.blocks(PAGE)
    assert main_text.choose(page, np.zeros(500, bool)) == "Head & tail One bolder word. Next line é"


def test_repeats_match_plain_search():
    rng = np.random.default_rng(3)
    streams = [[str(w) for w in rng.integers(0, 4, int(rng.integers(0, 40)))] for _ in range(12)]
    got = main_text.repeated(streams, run=4, percent=30, least=3)
    seen = defaultdict(set)
    for i, s in enumerate(streams):
        for k in range(len(s) - 3):
            seen[tuple(s[k : k + 4])].add(i)
    for s, covered in zip(streams, got):
        want = np.zeros(len(s), bool)
        for k in range(len(s) - 3):
            if len(seen[tuple(s[k : k + 4])]) >= 4:
                want[k : k + 4] = True
        assert np.array_equal(covered, want)


def test_main_text_without_markup_hints(spark):
    words = np.random.default_rng(6)
    frame = []
    for i in range(30):
        own = " ".join(f"w{k}" for k in words.integers(0, 5000, 60))
        notice = "please sign up today for the daily letter of this site"
        frame.append((i, "http://H.example/x", f"<div>{notice}</div><p>{own}</p><div>{notice}</div>", own))
    pages = spark.createDataFrame(frame, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in main_text.extract(pages).collect()}
    assert got == {i: own for i, _, _, own in frame}
    odd = spark.createDataFrame([(None, None, None), (1, "", ""), (1, "u", "<p>a<"), (2, "http://h/", "<p>" * 3000)], "page_id long, url string, html string")
    rows = main_text.extract(odd).collect()
    assert sorted((r.text, r.n_chars) for r in rows) == [("", 0), ("", 0), ("", 0), ("a<", 2)]
    assert main_text.extract(odd.limit(0)).count() == 0


def test_main_text_of_the_tables(spark, duck):
    want = duck.execute("SELECT page_id, html FROM pages").fetchall()
    got = {r.page_id: r for r in queries.op1_main_text(spark, FOLDER).collect()}
    assert len(got) == len(want)
    for key, html in want:
        article = html[html.index("<article>") + 9 : html.index("</article>")]
        assert got[key].text == main_text.choose(main_text.blocks(f"<article>{article}</article>"), None)
        assert got[key].n_chars == len(got[key].text) > 0


@pytest.mark.parametrize("start, end", [
    ('<body class="has-sidebar"><p>', ""),
    ('<div class="content no-sidebar"><p>', "</div>"),
    ('<article class="post overflow-hidden"><p>', "</article>"),
    ('<main class="search-page"><p>', "</main>"),
    ('<div id="modal"><main><p>', "</main></div>"),
    ("<article><datalist><option>A<option>B</datalist><p>", "</article><select><option>x</option></select>"),
    ("<article><p><button>Buy<p>", "</article><div><button>x</button></div>"),
    ("<body><video src=x><p>", "</body>"),
    ("<article><div><svg><path></div><p>", "</article><svg></svg>"),
])
def test_main_text_is_not_dropped_whole(start, end):
    got = main_text.choose(main_text.blocks(f"{start}All of the <i>article</i> text.</p>{end}"), None if "article" in start or "main" in start or "content" in start else np.zeros(9, bool))
    assert got == "All of the article text."


def test_main_text_keeps_chrome_out():
    page = '<div class="post-navigation">Next</div><div class="right-sidebar">Side</div><article><button><div>Buy</div> now</button><p>Text.</p><div class="related posts-list">More</div></article>'
    assert main_text.choose(main_text.blocks(page), None) == "Text."
    links = main_text.blocks('<p><a href="/a">All in links</a></p>')
    assert main_text.choose(links, np.zeros(9, bool)) == "All in links"


def test_main_text_counts_repeats_over_the_whole_host(spark, monkeypatch):
    """A passage on 4 pages of 1,500 is boilerplate as it is on 4 pages of 10."""
    words = np.random.default_rng(7)
    notice = "please sign up today for the daily letter of this site"
    rows = []
    for host, n in (("small", 10), ("large", 1500)):
        for i in range(n):
            own = " ".join(f"w{k}" for k in words.integers(0, 50_000, 40))
            extra = f"<div>{notice}</div>" if i % (n // 4 + 1) == 0 else ""
            rows.append((len(rows), f"http://{host}.example/{i}", f"{extra}<p>{own}</p>", own))
    assert sum(notice in h for _, _, h, _ in rows) == 8
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for limit in (main_text._MAX_BROADCAST_BYTES, -1):
        monkeypatch.setattr(main_text, "_MAX_BROADCAST_BYTES", limit)
        got = {r.page_id: r.text for r in main_text.extract(pages).collect()}
        assert got == {i: own for i, _, _, own in rows}


def test_main_text_marks_equal_the_plain_search():
    rng = np.random.default_rng(8)
    pages = [[" ".join(str(w) for w in rng.integers(0, 3, int(rng.integers(1, 90))))] for _ in range(12)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(12), pa.int64()), pa.array(["h"] * 12), pa.array(pages), pa.array(range(12), pa.int64())],
        ["unit", "host", "texts", "group"],
    )
    found = defaultdict(set)
    tables = [pa.Table.from_batches([b]) for b in main_text._dealt(4)()(batch)]
    for table in tables:
        for bucket in set(table["bucket"].to_pylist()):
            out = main_text._of_bucket(table.filter(pc.equal(table["bucket"], bucket)))
            for unit, marks in zip(out["unit"].to_pylist(), out["marks"].to_pylist()):
                found[unit].update(main_text._long(marks).tolist())
    numbers = main_text._Numbers()
    for k, want in enumerate(main_text.repeated([p[0].split(" ") for p in pages])):
        _, first, h = main_text._suffixes(numbers, ["h"], [pages[k]], main_text.RUN)
        got = np.zeros(len(want), bool)
        for at, x in zip(first, h & np.uint64((1 << 48) - 1)):
            got[at : at + main_text.RUN] |= int(x) in found[k]
        assert np.array_equal(got, want)


def test_main_text_code_carries_no_tables():
    """Tasks get code without the hash tables, which every executor would write to its disk."""
    for make in (main_text._read_pages, main_text._dealt(4), main_text._cut_pages("page_id"), ngram_join.word_hashes):
        ngram_join.word_hashes(b"tables that are made here")
        assert len(cloudpickle.dumps(make)) < 200_000


def test_main_text_sketch_is_narrow_and_keeps_repeats():
    """Few bytes a suffix; what three groups share passes the bitmap, single suffixes mostly do not."""
    rng = np.random.default_rng(12)
    notice = "please sign up today for the daily letter of this site"
    pages = [[" ".join(f"w{k}" for k in rng.integers(0, 1 << 40, 300)), notice] for _ in range(200)]
    pages += [["only two pages have this line of words in common"]] * 2 + [[], ["a b"]]
    group = np.arange(len(pages))
    bits, buckets = 20, 4
    rows = []
    for part in (slice(0, 100), slice(100, None)):
        n = len(pages[part])
        batch = pa.RecordBatch.from_arrays([pa.array(["h"] * n), pa.array(pages[part], pa.list_(pa.string())), pa.array(group[part])], ["host", "texts", "group"])
        rows += [r for out in main_text._sketch(bits, buckets)([batch]) for r in out.to_pylist()]
    _, _, h = main_text._suffixes(main_text._Numbers(), ["h"] * len(pages), pages, main_text.RUN)
    assert sum(len(r["hashes"]) for r in rows) < 2 * len(h)
    often = []
    for bucket in range(buckets):
        own = main_text._often((1 << bits) // buckets)(pa.Table.from_pylist([r for r in rows if r["bucket"] == bucket]))
        often += [main_text._unpacked(r["hashes"]) + np.uint64(bucket * (1 << bits) // buckets) for r in own.to_pylist()]
    marks = np.zeros(1 << bits, bool)
    marks[np.concatenate(often)] = True
    passing = main_text._passing(h, np.packbits(marks))
    values, counts = np.unique(h, return_counts=True)
    assert set(values[counts >= 3]) <= set(h[passing].tolist()) and len(set(h[passing].tolist())) < len(values) // 20
    for width in (1 << 12, 1 << 40):
        some = np.sort(rng.integers(0, width, 500).astype(np.uint64))
        assert np.array_equal(main_text._unpacked(main_text._packed(some, width)), some)
    few = main_text._few_groups(np.array([5, 1, 5, 5, 5, 5, 9], np.uint64), np.array([2, 8, 2, 3, 1, 4, 2]))
    assert [x.tolist() for x in few] == [[1, 5, 5, 5, 9], [8, 1, 2, 3, 2]]


def test_main_text_compares_few_signatures(spark):
    """Near copies are found among pages that share a band; a lone page takes no part."""
    rng = np.random.default_rng(13)
    story = [f"s{k}" for k in range(120)]
    rows = [(k, "http://h/", f"<p>{' '.join(story[:-1] + [f'x{k}'])}</p>") for k in range(6)]
    rows += [(k, "http://h/", "<p>" + " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 60)) + "</p>") for k in range(6, 30)]
    rows += [rows[0], rows[7]]
    got = main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted((k, h[3:-4]) for k, _, h in rows)


@pytest.mark.parametrize("element", ["article", "main", "div id=content"])
def test_main_text_cuts_boilerplate_in_every_zone(spark, element):
    words = np.random.default_rng(9)
    notice = "please sign up today for the daily letter of this site"
    rows = []
    for i in range(12):
        own = [" ".join(f"w{k}" for k in words.integers(0, 50_000, 40)) + "." for _ in range(2)]
        html = f"<p>{own[0]}</p><div>{notice}</div><p>{own[1]} Read all of it in our printed paper.</p>"
        rows.append((i, html, " ".join(own)))
    # Copies of an article, equal and with a few other words, are no boilerplate.
    story = [f"s{k}" for k in range(90)]
    for i in range(12, 36):
        copy = list(story)
        for k in words.integers(0, 90, i % 3):
            copy[k] = f"other{i}"
        rows.append((i, f"<p>{' '.join(copy)}</p>", " ".join(copy)))
    pages = spark.createDataFrame(
        [(i, f"http://h.example/{i}", f"<{element}>{h}</{element.split()[0]}>") for i, h, _ in rows],
        "page_id long, url string, html string",
    )
    got = {r.page_id: r.text for r in main_text.extract(pages).collect()}
    assert got == {i: text for i, _, text in rows}


def test_main_text_keeps_turns_of_phrase():
    covered = np.array([False] * 3 + [True] * 7 + [False] * 6)
    text = "a b c " + "d " * 7 + "e f g h i j."
    assert main_text.cut([text], covered) == text


class _NarrowGraph:
    """Finds links of large groups with any beam, other links with a beam of 96 only."""

    def __init__(self, x):
        self.x, self.widths = x, []

    def near_pairs(self, q, width, floor):
        self.widths.append(width)
        out = q @ self.x.T >= floor
        if width < 96:
            out[out.sum(1) < 20] = False
        return out


def test_hnsw_audit_sees_rare_links():
    rng = np.random.default_rng(12)
    unit = lambda v: (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    lone = unit(rng.normal(size=(2500, 48)))
    # Three links between two shards.
    graph = _NarrowGraph(lone[:2000])
    q = np.concatenate((lone[2000:], unit(lone[:3] + 0.01 * rng.normal(size=(3, 48)))))
    assert (hnsw_dedup._audited(graph, q, 0.93) == (q @ graph.x.T >= 0.93)).all()
    # A large group beside isolated pairs in one shard: the beam is widened.
    group = unit(lone[:1] + 0.01 * rng.normal(size=(900, 48)))
    x = np.concatenate((group, lone[1:1001], unit(lone[1:1001] + 0.01 * rng.normal(size=(1000, 48)))))
    graph = _NarrowGraph(x)
    found = hnsw_dedup._audited(graph, x, 0.93, same=True)
    want = x @ x.T >= 0.93
    np.fill_diagonal(found, True)
    assert (found == want).all() and max(graph.widths) >= 96
