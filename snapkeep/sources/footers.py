"""Counts and extremes of Parquet tables from their footers.

Parquet keeps the row count and column statistics of each file in its footer.
Spark's V2 Parquet source can answer counts, minima and maxima from there
(aggregate push-down), also by partition column: a task reads a footer
instead of the file's pages, and one row a file is aggregated instead of one a
record.  The push-down is a session setting and off by default, so the frames
here belong to a session of their own beside the caller's (same application,
catalog and executors, the caller's SQL settings).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import col, resolve_name
from ..session import SQL_SETTINGS

# Spark's list of formats read by the V1 source, without parquet.
_V1_WITHOUT_PARQUET = "avro,csv,json,kafka,orc,text"


def footer_session(spark: SparkSession) -> SparkSession:
    """A session that answers Parquet aggregates from footers where it can."""
    other = spark.newSession()
    for k in (*SQL_SETTINGS, "spark.sql.shuffle.partitions"):
        other.conf.set(k, spark.conf.get(k))
    other.conf.set("spark.sql.sources.useV1SourceList", _V1_WITHOUT_PARQUET)
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def footer_stats(
    spark: SparkSession, path: str, partition_by: Sequence[str] = (), extremes: Sequence[str] = ()
) -> DataFrame:
    """`n_rows` of a Parquet table, by its partition columns if named, with
    `min_<c>` and `max_<c>` of the columns in `extremes`.

    Extremes come from footers for boolean, number and date columns; with a
    text, timestamp or nested column in the list Spark reads the pages instead.
    """
    df = footer_session(spark).read.parquet(path)
    keys = [resolve_name(df, c) for c in partition_by]
    names = [resolve_name(df, c) for c in extremes]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for n in names:
        aggs += [F.min(col(n)).alias(f"min_{n}"), F.max(col(n)).alias(f"max_{n}")]
    return df.groupBy(*[col(k) for k in keys]).agg(*aggs) if keys else df.agg(*aggs)


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``(table, n_rows)`` of each named Parquet path, from footers, in one job."""
    if not paths:
        raise ValueError("no paths given")
    session = footer_session(spark)
    parts = [
        session.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, p in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)
