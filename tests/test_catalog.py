"""Every registered query equals its SQL text on DuckDB (sf0.001 here; the
driver checks sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from snapkeep.catalog import QUERIES, TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert rows_of(df.columns, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "offset" and df.columns[-1] == "extract_date"


def test_plan_report_covers_every_query():
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), encoding="utf-8") as f:
        report = f.read()
    assert [q for q in QUERIES if q not in report] == []
