"""Driver contract: entry smoke run, registry shape, and every query vs its DuckDB oracle."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and len(df.columns) == 14


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    ours = sorted(tuple(_norm(x) for x in r) for r in df.collect())
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in cols]
    theirs = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert ours == theirs
