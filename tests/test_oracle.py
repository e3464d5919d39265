"""Every registered query against its DuckDB statement (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, rows_of

SF = os.environ.get("BASKETRY_ORACLE_SF", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    s_rows = [r.asDict(recursive=True) for r in sdf.collect()]
    rel = con.sql(SQL[name])
    d_rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    cols = sorted(sdf.columns)
    assert rows_of(s_rows, cols) == rows_of(d_rows, cols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns
