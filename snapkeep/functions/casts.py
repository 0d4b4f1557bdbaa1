"""Type casts used by the flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .naming import col, resolve_name


def exact_int(c: Column, name: str) -> Column:
    """Narrow to INT; a value that does not fit fails the job."""
    fits = c.isNull() | c.between(-(2**31), 2**31 - 1)
    message = F.concat(F.lit(f"{name} does not fit in INT: "), c.cast("string"))
    return F.when(fits, c).otherwise(F.raise_error(message)).cast("int")


def envelope_columns(offset_type: str = "bigint", strict_int: bool = False) -> list[Column]:
    """`offset`, `key`, `value` of a topic envelope, with key and value as text.

    Offsets are 64-bit: narrowing them to INT overflows past 2^31-1 (and
    fails the job under ANSI mode).  `strict_int=True` narrows for
    output-type parity and fails the job on an offset that does not fit, in
    either mode: an offset is never lost silently.
    """
    off = F.col("offset")
    off = exact_int(off, "offset") if strict_int else off.cast(offset_type)
    return [
        off.alias("offset"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    ]


def to_date_column(c: str | Column) -> Column:
    """Timestamp -> date in the session time zone (NTZ values as written)."""
    c = col(c) if isinstance(c, str) else c
    return c.cast("date")


def with_date_from(df: DataFrame, target: str, source: str) -> DataFrame:
    """Set `target` to the date of `source`, replacing a same-named column."""
    src = resolve_name(df, source)
    existing = [c for c in df.columns if c.lower() == target.lower()]
    name = existing[0] if existing else target
    return df.withColumn(name, to_date_column(src)).withColumnRenamed(name, target)
