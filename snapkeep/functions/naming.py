"""Column-name helpers.

Names are always backtick-quoted before lookup, so names holding dots or
other special characters resolve as plain top-level columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """Backtick-quote a column name (escaping embedded backticks)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col(quote(name))


def resolve_name(df: DataFrame, name: str) -> str:
    """The frame's own spelling of `name`, matched case-insensitively."""
    for c in df.columns:
        if c == name:
            return c
    low = name.lower()
    hits = [c for c in df.columns if c.lower() == low]
    if len(hits) != 1:
        raise ValueError(f"column {name!r} not found (or ambiguous) in {df.columns}")
    return hits[0]


def lowercase_partitions(df: DataFrame, partition_by: Iterable[str]) -> tuple[DataFrame, list[str]]:
    """Alias the partition columns to lower case; data columns keep their names.

    Hive-style partition directories are mapped by lower-case names, so the
    partition columns are renamed before a partitioned write.  The request is
    matched case-insensitively against the frame (as Spark resolves names).
    """
    wanted = {resolve_name(df, p) for p in partition_by}
    cols = [col(c).alias(c.lower()) if c in wanted else col(c) for c in df.columns]
    ordered = [resolve_name(df, p).lower() for p in partition_by]
    return df.select(*cols), ordered
