"""Every registered query against its DuckDB oracle on the smallest data set."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.plans import oracle, registry
from ledgerline.sources.base import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = dict(registry.QUERIES)
ORACLES = dict(oracle.ORACLE)


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == ["month", "mrr_amount"]
    assert df.count() > 0
