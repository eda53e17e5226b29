"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from lakemart.plans.registry import load_all
from lakemart.plans.tables import TABLES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"
REG = load_all()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(REG))
def test_query(spark, con, name):
    e = REG[name]
    df = e.fn(spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if e.sql is None:
        assert df.columns
        return
    res = con.execute(e.sql)
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, rows) == rows_of(cols, res.fetchall())
