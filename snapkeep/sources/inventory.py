"""Inventory of a partitioned table: rows, files and bytes per partition value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import col, resolve_name


def partition_inventory(
    df: DataFrame, partition_cols: Sequence[str], files: bool = True, sizes: bool = False
) -> DataFrame:
    """Rows, data files (`files`) and bytes of these files (`sizes`) per
    partition value of a file-source frame.

    Runs as one distributed aggregation over partition discovery, at every
    directory depth.  Spark's own file index lists the table on the driver (in
    parallel tasks beyond its threshold of paths); rows are read for the count
    only.  `sources.footer_stats` answers row counts without reading rows.
    """
    names = [resolve_name(df, c) for c in partition_cols]
    if not (files or sizes):
        return df.groupBy(*[col(n) for n in names]).agg(F.count(F.lit(1)).alias("n_rows"))
    # first one row per file, so that a file's size counts once
    per_file = df.groupBy(
        *[col(n) for n in names], F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_size").alias("__size")
    ).agg(F.count(F.lit(1)).alias("__n"))
    aggs = [F.sum("__n").alias("n_rows")]
    if files:
        aggs.append(F.count(F.lit(1)).alias("n_files"))
    if sizes:
        aggs.append(F.sum("__size").alias("n_bytes"))
    return per_file.groupBy(*[col(n) for n in names]).agg(*aggs)
