"""Every registered query against its DuckDB oracle at sf0.001 (the driver's gate)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from conftest import SF_SMALL

TABLES = ["part", "orders", "customer", "lineitem", "supplier", "nation", "region",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SQL = se.oracle_sql()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(df.columns) > 0
        return
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())


def test_entry_runs(spark):
    assert se.entry(spark).count() > 0
