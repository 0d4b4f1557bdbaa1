import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapkeep.sinks.tables import write_table
from snapkeep.plans import table_counts
from snapkeep.sources import partition_inventory, read_csv, read_parquet, read_parquets, read_snapshot


def days_df(spark, days, tag):
    return spark.createDataFrame(
        [(dt.date(2024, 1, d), tag) for d in days], "EXTRACT_DATE date, tag string"
    )


def tags_by_day(spark, path):
    return sorted((r["extract_date"].day, r["tag"]) for r in spark.read.parquet(path).collect())


def test_dynamic_overwrite_replaces_only_incoming_days(spark, tmp):
    write_table(days_df(spark, [1, 2], "a"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    write_table(days_df(spark, [2, 3], "b"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    assert tags_by_day(spark, tmp + "/t") == [(1, "a"), (2, "b"), (3, "b")]
    # rerun of the same day is idempotent
    write_table(days_df(spark, [2, 3], "b"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    assert tags_by_day(spark, tmp + "/t") == [(1, "a"), (2, "b"), (3, "b")]


def test_static_overwrite_replaces_everything(spark, tmp):
    write_table(days_df(spark, [1, 2], "a"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    write_table(days_df(spark, [2], "b"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"],
                overwrite="static")
    assert tags_by_day(spark, tmp + "/t") == [(2, "b")]


def test_partition_directories_are_lower_case(spark, tmp):
    write_table(days_df(spark, [1], "a"), tmp + "/t", mode="overwrite", partition_by=["Extract_Date"],
                layout="coalesce", partitions=5)
    assert [d for d in os.listdir(tmp + "/t") if "=" in d] == ["extract_date=2024-01-01"]


def test_partition_directory_read_and_snapshot_pruning(spark, tmp):
    write_table(days_df(spark, [1, 2], "a"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    one_dir = read_parquet(spark, tmp + "/t/extract_date=2024-01-02")
    assert one_dir.columns == ["tag"]
    with_base = read_parquet(spark, tmp + "/t/extract_date=2024-01-02", base_path=tmp + "/t")
    assert with_base.schema["extract_date"].dataType == T.DateType()
    snap = read_snapshot(spark, tmp + "/t", "2024-01-02")
    assert [(r["tag"], r["extract_date"]) for r in snap.collect()] == [("a", dt.date(2024, 1, 2))]
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extract_date" in plan and "2024-01-02" in plan
    # only the day's directory is listed, not the whole lake
    assert snap.inputFiles() and all("extract_date=2024-01-02" in f for f in snap.inputFiles())
    with pytest.raises(AnalysisException):
        read_snapshot(spark, tmp + "/t", "2024-01-09").collect()
    typed = read_snapshot(spark, tmp + "/t", "2024-01-01", schema="tag string, missing string")
    assert typed.columns == ["tag", "missing", "extract_date"]


def test_inventory_counts_rows_and_files(spark, tmp):
    write_table(days_df(spark, [1, 1, 2], "a").repartition(2), tmp + "/t", mode="overwrite",
                partition_by=["EXTRACT_DATE"], layout="none")
    inv = {r["extract_date"].day: (r["n_rows"], r["n_files"])
           for r in partition_inventory(spark.read.parquet(tmp + "/t"), ["extract_date"]).collect()}
    assert inv[1][0] == 2 and inv[2][0] == 1 and inv[1][1] >= 1


def test_explicit_parquet_schema(spark, tmp):
    spark.createDataFrame([(1, "x")], "a bigint, b string").write.parquet(tmp + "/p")
    df = read_parquet(spark, tmp + "/p", schema="A bigint, extra string")
    assert [tuple(r) for r in df.collect()] == [(1, None)]
    with pytest.raises(Exception):
        read_parquet(spark, tmp + "/p", schema="b bigint").collect()


def test_multi_path_needs_schema_or_merge(spark, tmp):
    spark.createDataFrame([(1,)], "a bigint").write.parquet(tmp + "/p1")
    spark.createDataFrame([(2, "y")], "a bigint, b string").write.parquet(tmp + "/p2")
    merged = read_parquets(spark, [tmp + "/p2", tmp + "/p1"], merge_schema=True)
    assert sorted(merged.columns) == ["a", "b"] and merged.count() == 2
    fixed = read_parquets(spark, [tmp + "/p1", tmp + "/p2"], schema="a bigint, b string")
    assert sorted((r["a"], r["b"]) for r in fixed.collect()) == [(1, None), (2, "y")]


def test_csv_binds_by_position(spark, tmp):
    spark.createDataFrame([(1, "x")], "n int, s string").write.option("header", "true").csv(tmp + "/c")
    inferred = read_csv(spark, tmp + "/c")
    assert dict(inferred.dtypes) == {"n": "int", "s": "string"}
    swapped = read_csv(spark, tmp + "/c", schema="s string, n int")
    assert [tuple(r) for r in swapped.collect()] == [("1", None)]
    with pytest.raises(Exception):
        read_csv(spark, tmp + "/c", schema="s string, n string", strict_header=True).collect()


def test_dotted_partition_and_data_columns(spark, tmp):
    df = spark.createDataFrame([(1, "d")], "`a.b` int, `Part.X` string")
    write_table(df, tmp + "/d", mode="overwrite", partition_by=["part.x"])
    back = spark.read.parquet(tmp + "/d")
    assert sorted(back.columns) == ["a.b", "part.x"]
    with pytest.raises(AnalysisException):
        back.select("a.b").collect()
    assert back.select("`a.b`").first()[0] == 1


def test_format_round_trips(spark, tmp):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    for fmt in ("json", "csv", "parquet", "orc"):
        out = f"{tmp}/{fmt}"
        write_table(part, out, fmt=fmt, mode="overwrite", options={"header": "true"} if fmt == "csv" else None)
        r = spark.read.schema(part.schema).format(fmt)
        if fmt == "csv":
            r = r.option("header", "true")
        back = r.load(out)
        assert back.exceptAll(part).count() == 0 and part.exceptAll(back).count() == 0


def test_csv_inference_reads_every_row(spark, tmp):
    spark.range(5000).selectExpr("if(id = 4999, 'text', cast(id as string)) AS n").write.option("header", "true").csv(tmp + "/c")
    df = read_csv(spark, tmp + "/c")
    assert dict(df.dtypes)["n"] == "string"
    assert df.where("n is null").count() == 0 and df.where("n = 'text'").count() == 1


def test_table_counts_by_format(spark, tmp):
    df = spark.range(10).selectExpr("id", "concat('x', id) AS s")
    for fmt in ("csv", "json", "orc", "parquet"):
        w = df.write.option("header", "true") if fmt == "csv" else df.write
        w.format(fmt).save(f"{tmp}/{fmt}")
        assert [r["n_rows"] for r in table_counts(spark, {fmt: f"{tmp}/{fmt}"}, fmt=fmt).collect()] == [10]


def test_partition_count_caps_files(spark, tmp):
    write_table(days_df(spark, [1] * 64, "a").repartition(8), tmp + "/t", mode="overwrite",
                partition_by=["EXTRACT_DATE"], partitions=2)
    inv = partition_inventory(spark.read.parquet(tmp + "/t"), ["extract_date"], sizes=True).collect()
    assert inv[0]["n_rows"] == 64 and inv[0]["n_files"] <= 2 and inv[0]["n_bytes"] > 0


def test_snapshot_day_in_basic_form(spark, tmp):
    write_table(days_df(spark, [7], "a"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    assert read_snapshot(spark, tmp + "/t", "20240107").count() == 1


def _failing_rerun(spark, days):
    # A rerun whose job fails part-way (one task raises) after others wrote files.
    df = days_df(spark, days, "b").repartition(len(days))
    return df.withColumn("tag", F.when(F.dayofmonth("EXTRACT_DATE") == days[-1], F.raise_error(F.lit("boom")))
                         .otherwise(F.col("tag")))


def test_failed_dynamic_rerun_keeps_every_day(spark, tmp):
    write_table(days_df(spark, [1, 2, 3], "a"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    with pytest.raises(Exception):
        write_table(_failing_rerun(spark, [2, 3]), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    # nothing was committed: the old days are all still there, unchanged
    assert tags_by_day(spark, tmp + "/t") == [(1, "a"), (2, "a"), (3, "a")]
    write_table(days_df(spark, [2, 3], "b"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    assert tags_by_day(spark, tmp + "/t") == [(1, "a"), (2, "b"), (3, "b")]


def test_csv_inference_types_and_empty_cells(spark, tmp):
    os.makedirs(tmp + "/typed")
    with open(tmp + "/typed/part.csv", "w") as f:
        f.write("n,d,t,x,s\n1,2024-03-07,2024-03-07 12:00:00,1.5,a\n2,,,,\n")
    df = read_csv(spark, tmp + "/typed")
    assert dict(df.dtypes) == {"n": "int", "d": "date", "t": "timestamp", "x": "double", "s": "string"}
    rows = sorted(df.collect(), key=lambda r: r["n"])
    assert rows[1]["d"] is None and rows[1]["t"] is None and rows[1]["x"] is None and rows[1]["s"] is None


def test_dynamic_rewrite_of_a_table_from_itself(spark, tmp):
    write_table(days_df(spark, [1, 2], "a"), tmp + "/t", mode="overwrite", partition_by=["EXTRACT_DATE"])
    back = spark.read.parquet(tmp + "/t").withColumn("tag", F.lit("b"))
    write_table(back.where(F.dayofmonth("extract_date") == 2), tmp + "/t", mode="overwrite",
                partition_by=["extract_date"])
    assert tags_by_day(spark, tmp + "/t") == [(1, "a"), (2, "b")]


def test_unpartitioned_overwrite_is_staged(spark, tmp):
    import os

    path = tmp + "/t"
    write_table(spark.range(3), path, mode="overwrite")
    bad = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_table(bad, path, mode="overwrite")
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [0, 1, 2]
    # rewritten from itself
    write_table(spark.read.parquet(path).where("id > 0"), path, mode="overwrite")
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [1, 2]
    assert os.listdir(tmp) == ["t"]
    with pytest.raises(ValueError, match="unknown overwrite"):
        write_table(spark.range(1), path, mode="overwrite", overwrite="other")


def test_static_unpartitioned_overwrite_writes_in_place(spark, tmp):
    write_table(spark.range(3), tmp + "/t", mode="overwrite", overwrite="static")
    write_table(spark.range(1), tmp + "/t", mode="overwrite", overwrite="static")
    assert spark.read.parquet(tmp + "/t").count() == 1
