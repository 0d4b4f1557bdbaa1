"""CSV bound by header name, and counts from footers."""

import os

import pytest
from pyspark.sql import functions as F

from snapkeep.sources import footer_counts, footer_stats, read_csv, read_csv_by_name

SCHEMA = "id bigint, name string, day date"


def put(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def rows(df):
    return sorted((tuple(str(v) if v is not None else None for v in r) for r in df.collect()), key=str)


def test_swapped_columns_read_right(spark, tmp):
    put(f"{tmp}/c", "a.csv", "id,name,day\n1,x,2024-01-01\n")
    put(f"{tmp}/c", "b b.csv", "day,ID,extra,Name\n2024-01-02,2,zz,y\n2024-01-03,3,,\n")
    put(f"{tmp}/c", "c.csv", "id,name,day\n4,\"q, r\",\n")
    expected = [("1", "x", "2024-01-01"), ("2", "y", "2024-01-02"), ("3", None, "2024-01-03"), ("4", "q, r", None)]
    assert rows(read_csv_by_name(spark, f"{tmp}/c", SCHEMA)) == expected
    # by position the second file's values land in the wrong columns
    assert rows(read_csv(spark, f"{tmp}/c", schema=SCHEMA)) != expected


def test_missing_columns(spark, tmp):
    put(f"{tmp}/c", "a.csv", "name\nx\n")
    with pytest.raises(ValueError, match="has no column"):
        read_csv_by_name(spark, f"{tmp}/c", SCHEMA)
    assert rows(read_csv_by_name(spark, f"{tmp}/c", SCHEMA, missing="null")) == [(None, "x", None)]
    with pytest.raises(ValueError, match="unknown missing"):
        read_csv_by_name(spark, f"{tmp}/c", SCHEMA, missing="drop")


def test_repeated_names_and_separators(spark, tmp):
    put(f"{tmp}/c", "a.csv", "id,name,NAME,day\n1,x,y,2024-01-01\n")
    with pytest.raises(ValueError, match="repeats"):
        read_csv_by_name(spark, f"{tmp}/c", SCHEMA)
    put(f"{tmp}/d", "a.csv", "name;day;id\nx,1;2024-01-01;7\n")
    assert rows(read_csv_by_name(spark, f"{tmp}/d", SCHEMA, options={"sep": ";"})) == [("7", "x,1", "2024-01-01")]


def test_only_needed_columns_are_parsed(spark, tmp):
    put(f"{tmp}/c", "a.csv", "id,name,day\n1,x,2024-01-01\n")
    plan = read_csv_by_name(spark, f"{tmp}/c", SCHEMA).select("name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan


def test_many_lines_and_blocks(spark, tmp):
    body = "".join(f"{i},n{i}\n" for i in range(20000))
    put(f"{tmp}/c", "a.csv", "id,name\n" + body)
    put(f"{tmp}/c", "b.csv", "name,id\n" + "".join(f"m{i},{-1 - i}\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        got = read_csv_by_name(spark, f"{tmp}/c", "id bigint, name string")
        r = got.agg(F.count("*"), F.sum("id"), F.count_if(F.col("name").startswith("m") == (F.col("id") < 0))).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tuple(r) == (40000, -20000, 40000)


def test_counts_come_from_footers(spark, tmp):
    spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("p")).write.partitionBy("p").parquet(f"{tmp}/t")
    by_p = footer_stats(spark, f"{tmp}/t", ["P"], ["id"])
    assert sorted(map(tuple, by_p.collect())) == [(0, 334, 0, 999), (1, 333, 1, 997), (2, 333, 2, 998)]
    for df in (by_p, footer_counts(spark, {"t": f"{tmp}/t"})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)" in plan
    assert [tuple(r) for r in footer_counts(spark, {"t": f"{tmp}/t"}).collect()] == [("t", 1000)]
    # the caller's session is as it was
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
