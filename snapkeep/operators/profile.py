"""Null-pattern profile: filter by which columns are null, then count groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import col, resolve_name


def null_pattern(df: DataFrame, null: Sequence[str] = (), not_null: Sequence[str] = ()) -> Column:
    cond: Column = F.lit(True)
    for c in null:
        cond = cond & col(resolve_name(df, c)).isNull()
    for c in not_null:
        cond = cond & col(resolve_name(df, c)).isNotNull()
    return cond


def null_profile(
    df: DataFrame,
    group_by: Sequence[str],
    null: Sequence[str] = (),
    not_null: Sequence[str] = (),
    count_name: str = "count",
    min_count: int = 1,
    ordered: bool = True,
) -> DataFrame:
    """Rows matching the null pattern, counted per group, biggest first.

    The filter is applied before the grouping (and pushed to the scan where
    the columns come straight from a file); the count is a two-phase hash
    aggregate, so a hot group costs one row per map task in the shuffle.
    """
    groups = [col(resolve_name(df, g)) for g in group_by]
    out = (
        df.where(null_pattern(df, null, not_null))
        .groupBy(*groups)
        .agg(F.count(F.lit(1)).alias(count_name))
        .where(F.col(count_name) >= min_count)
    )
    return out.orderBy(F.col(count_name).desc()) if ordered else out
