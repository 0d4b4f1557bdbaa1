"""Versioned tables: staged overwrite, conflicts, buckets."""

import os

import pytest
from pyspark.sql import functions as F

from snapkeep.sinks import Buckets, VersionConflict, read_current, read_version, write_bucketed, write_version
from snapkeep.sinks.buckets import deal, read_bucketed
from snapkeep.sinks.versions import version_numbers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def numbers(spark, n, value):
    return spark.range(n).select(F.col("id"), F.lit(value).alias("value"))


def failing(spark):
    return spark.range(100).select("id", F.when(F.col("id") == 99, F.raise_error(F.lit("boom"))).otherwise("x").alias("value"))


@pytest.mark.parametrize("fmt,options", [("parquet", {}), ("csv", {"header": "true"}), ("json", {})])
def test_overwrite_keeps_rows_and_history(spark, tmp, fmt, options):
    root = f"{tmp}/t"
    assert read_version(spark, root) is None
    write_version(numbers(spark, 3, "a"), root, fmt=fmt, options=options)
    old = read_current(spark, root)
    entry = write_version(numbers(spark, 5, "b"), root, fmt=fmt, options=options, facts={"who": "me"})
    assert entry["version"] == 2 and entry["n_rows"] == 5
    assert read_version(spark, root)["who"] == "me"
    assert rows(read_current(spark, root)) == [(i, "b") for i in range(5)]
    # a frame opened before the overwrite still reads its own version
    assert rows(old) == [(i, "a") for i in range(3)]
    assert rows(read_current(spark, root, 1)) == [(i, "a") for i in range(3)]


def test_failed_overwrite_leaves_the_old_rows(spark, tmp):
    root = f"{tmp}/t"
    write_version(numbers(spark, 3, "a"), root)
    with pytest.raises(Exception, match="boom"):
        write_version(failing(spark), root)
    assert rows(read_current(spark, root)) == [(i, "a") for i in range(3)]
    assert version_numbers(spark, root) == [1]
    assert len([d for d in os.listdir(root) if d.startswith("data-")]) == 1


def test_table_written_from_itself(spark, tmp):
    root = f"{tmp}/t"
    write_version(numbers(spark, 10, "a"), root)
    write_version(read_current(spark, root).where("id >= 4"), root)
    assert [r[0] for r in rows(read_current(spark, root))] == [4, 5, 6, 7, 8, 9]


def test_second_writer_conflicts(spark, tmp):
    root = f"{tmp}/t"
    write_version(numbers(spark, 1, "a"), root)
    write_version(numbers(spark, 2, "b"), root, expected=1)
    with pytest.raises(VersionConflict):
        write_version(numbers(spark, 3, "c"), root, expected=1)
    assert len(rows(read_current(spark, root))) == 2


def test_old_versions_are_removed_after_the_commit(spark, tmp):
    root = f"{tmp}/t"
    for n in range(1, 6):
        write_version(numbers(spark, n, "v"), root, keep=2)
    assert len([d for d in os.listdir(root) if d.startswith("data-")]) == 2
    assert version_numbers(spark, root) == [1, 2, 3, 4, 5]
    assert read_current(spark, root, 4).count() == 4
    with pytest.raises(FileNotFoundError):
        read_current(spark, root, 9)
    with pytest.raises(FileNotFoundError):
        read_current(spark, f"{tmp}/none")


def test_bucketed_files_and_plans(spark, tmp):
    b = Buckets("k", 4)
    left = spark.range(200).select((F.col("id") % 50).alias("k"), F.col("id").alias("odd col.name"))
    write_bucketed(left, f"{tmp}/left", b)
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    write_bucketed(deal(right, b), f"{tmp}/right", b, dealt=True)
    assert len([f for f in os.listdir(f"{tmp}/left") if f.endswith(".parquet")]) <= 4
    x, y = read_bucketed(spark, f"{tmp}/left", left.schema, b), read_bucketed(spark, f"{tmp}/right", right.schema, b)
    joined = x.hint("merge").join(y.hint("merge"), "k", "left_outer")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 200
    assert rows(x) == rows(left)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("snapkeep_")]


def test_bad_buckets():
    with pytest.raises(ValueError):
        Buckets((), 4)
    with pytest.raises(ValueError):
        Buckets("k", 0)
