"""Row counts of tables as one result."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row ``(table, n_rows)``; a global count reads no column data."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``row_count`` of every frame, unioned (one Spark job for all)."""
    parts = [row_count(df, name) for name, df in frames.items()]
    if not parts:
        raise ValueError("no frames given")
    return reduce(DataFrame.unionByName, parts)
