"""Parquet scans: one path, many paths, one day of a partitioned lake."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import col


def _reader(spark: SparkSession, schema: T.StructType | str | None, merge_schema: bool):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    elif merge_schema:
        r = r.option("mergeSchema", "true")
    return r


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """Read Parquet with an explicit schema or from the file footers.

    With a schema, its columns missing from a file come back null and names
    match case-insensitively; a column stored with another type fails the
    read.  Filters and projections on the result reach the scan.
    """
    r = _reader(spark, schema, merge_schema)
    if base_path:
        r = r.option("basePath", base_path)
    return r.parquet(path)


def read_parquets(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Read several Parquet paths as one frame (rows of every path, duplicates kept).

    Without a schema and without `merge_schema` Spark takes the columns of
    one footer, so paths with different columns must pass one of the two.
    """
    if not paths:
        raise ValueError("no paths given")
    return _reader(spark, schema, merge_schema).parquet(*paths)


def day_literal(day: str | dt.date) -> F.Column:
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return F.lit(day)


def read_snapshot(
    spark: SparkSession,
    root: str,
    day: str | dt.date | None = None,
    schema: T.StructType | str | None = None,
    partition_col: str = "extract_date",
) -> DataFrame:
    """One day of a date-partitioned snapshot lake (or all days).

    Only the day's directory is listed (``basePath`` is the lake root, so
    the partition column stays in the result, typed date): a lake holding
    years of days is not listed file by file to read one of them, as a read
    of the root followed by a partition filter would be.  The filter is
    kept as well, so the day is also pruned if the directory holds deeper
    partitions.  A missing day fails the read, like a missing path.  A
    schema, if given, describes the data columns; the partition column is
    added to it.
    """
    r = spark.read
    if schema is not None:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        if partition_col.lower() not in [f.name.lower() for f in schema.fields]:
            schema = T.StructType(list(schema.fields) + [T.StructField(partition_col, T.DateType())])
        r = r.schema(schema)
    if day is None:
        return r.parquet(root)
    day_text = (dt.date.fromisoformat(day) if isinstance(day, str) else day).isoformat()
    df = r.option("basePath", root).parquet(f"{root.rstrip('/')}/{partition_col}={day_text}")
    return df.where(col(partition_col) == day_literal(day))
