"""The training-data queries that SQL can express."""

from __future__ import annotations

import duckdb
import pytest

from tidelog.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    places = [want.columns.index(c) for c in columns]
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(tuple(r[k] for k in places) for r in want.fetchall())


def test_sql_on_odd_vectors(spark):
    from tidelog.llm import vectors

    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.2]), (4, [1.0, 0.55]), (5, None), (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [1.0]), (9, [1.0])]
    con = duckdb.connect()
    con.sql("create table embeddings(vec_id bigint, embedding float[])")
    con.executemany("insert into embeddings values (?, ?)", rows)
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    want = con.sql(ORACLE_SQL["op4_embedding_near_dedup"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
