"""Every registered query against its SQL in another engine, at the smallest scale."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tidelog.plans import ORACLE_SQL, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{Path(sf_dir) / t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = duck.sql(ORACLE_SQL[name])
    assert columns == sorted(want.columns)
    places = [want.columns.index(c) for c in columns]
    got_rows = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    assert got_rows == sorted(tuple(plain(r[k]) for k in places) for r in want.fetchall())
