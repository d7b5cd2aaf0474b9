"""The pipeline stage by stage, each against its own rule."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from linkloom.llm import mixing, pii, quality_rules

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    tables = []
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, FOLDER).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        tables.append({r.doc_id: r for r in docs.collect()})
        assert k == 4 or docs.columns == columns
    good, first, masked, mixed, packed = tables
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    kept = con.execute(f"SELECT doc_id FROM ({quality_rules.sql()}) WHERE kept").fetchall()
    assert set(good) == {i for (i,) in kept}
    assert set(first) < set(good) and set(masked) == set(first)
    assert all(masked[i].text == pii.masked(first[i].text) for i in first)
    assert set(mixed) <= set(masked) and 0.6 * len(masked) < len(mixed)
    assert set(packed) == set(mixed)


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_quality_filter_reads_long_texts_once(spark):
    """Hashing all words again for each window would take hours here."""
    words = ["the", "quiet", "river"] + [f"word{k}" for k in range(20_000)]
    good = " ".join(w if k % 10 else "the" for k, w in enumerate(words))
    rows = [(1, good), (2, good + " again and again and again" * 4000), (3, "short"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in quality_rules.keep_good(docs).collect()] == [1]


def test_mixture_meets_its_targets(spark):
    """A source with a third of all tokens, 19 equal ones and one with a thousandth."""
    sizes = {"hot": 6000, "tiny": 180} | {f"s{k}": 620 for k in range(19)}
    rows = [
        (f"{s}-{i}", "a quiet river runs" + " on" * (i % 7), "de" if (i + k) % 9 == 0 else "en", s)
        for k, (s, n) in enumerate(sizes.items())
        for i in range(n // 10 if s == "tiny" else n)
    ]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    out = corpus_pipeline.mixture(spark, docs, FOLDER)
    assert out.columns == docs.columns
    got = out.collect()
    for column, power in (("source", mixing.TEMPER["source"]), ("lang", mixing.TEMPER["language"])):
        before, after = {}, {}
        for into, table in ((before, docs.collect()), (after, got)):
            for r in table:
                into[r[column]] = into.get(r[column], 0) + len(r.text.split())
        raw = {k: (n / sum(before.values())) ** power for k, n in before.items()}
        for k, x in raw.items():
            want, share = x / sum(raw.values()), after[k] / sum(after.values())
            assert abs(share - want) < 0.006 and abs(share / want - 1) < 0.12, (k, want, share)


def test_raking_goes_on_until_the_marginals_fit(spark):
    cells = [(s, g, "prose", 100_000 if (a == b) else 1) for a, s in enumerate("xy") for b, g in enumerate("pq")]
    frame = spark.createDataFrame(cells, "_source string, _language string, _topic string, _tokens long").coalesce(1)
    given = {"source": {"x": 0.6}, "language": {"p": 0.5}}
    assert mixing.marginal_error(mixing.rake(frame, given=given)) > mixing.TOLERANCE
    assert mixing.marginal_error(mixing.rake_until(frame, mixing.TOLERANCE, given=given)) <= mixing.TOLERANCE
    stuck = frame.filter("_tokens > 1")
    with pytest.warns(UserWarning, match="largest marginal error"):
        mixing.rake_until(stuck, mixing.TOLERANCE, given=given)
