"""Every query of the catalogue against its SQL, on the same tables."""

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as spark_entry  # noqa: E402
from linkloom.plans.catalogue import QUERIES  # noqa: E402
from linkloom.plans.oracle import SQL  # noqa: E402

FOLDER = os.environ.get("CATALOGUE_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in row)


def _plain(value):
    return round(value, 9) if isinstance(value, float) and not math.isnan(value) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(SQL) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = spark_entry.queries()[name](spark, FOLDER)
    want = duck.execute(spark_entry.oracle_sql()[name])
    want_columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(want_columns)
    got_rows, want_rows = _rows(got.columns, got.collect()), _rows(want_columns, want.fetchall())
    assert len(got_rows) > 0
    different = [(g, w) for g, w in zip(got_rows, want_rows) if g != w]
    assert len(got_rows) == len(want_rows) and not different, (len(got_rows), len(want_rows), different[:2])
