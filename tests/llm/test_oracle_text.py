"""The text queries that SQL can express, against DuckDB over whole test tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from hexcohort.llm.queries import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    res = con.execute(SQL[name])
    columns = [d[0] for d in res.description]
    df = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, res.fetchall()))
