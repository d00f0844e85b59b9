"""Every query with checking SQL against DuckDB, over the whole test tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def tidy(rows):
    def val(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted([tuple(val(v) for v in r) for r in rows], key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry_point.queries()[name](spark, SF)
    res = duck.execute(entry_point.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert tidy(df.select(*cols).collect()) == tidy(res.fetchall())


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and "dominant_segment" in df.columns
