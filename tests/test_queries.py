"""Every query with a SQL twin gives the twin's rows on the smallest tables; the others give rows of a stable schema."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from rostrum import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.8g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = db.execute(catalog.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert df.columns and len(set(df.columns)) == len(df.columns) and df.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
