"""Queries of the package that SQL can express equal their SQL."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

from oracle_check import rows_of  # noqa: E402

from snapkeep.catalog import TABLES  # noqa: E402
from snapkeep.llm.queries import QUERIES, SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    columns = [c[0] for c in cur.description]
    assert rows_of(df.columns, rows) == rows_of(columns, cur.fetchall())
