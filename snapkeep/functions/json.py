"""JSON text -> typed columns by a fixed schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .naming import col, quote


def parse_json(c: str | Column, schema: T.StructType | str, corrupt_column: str | None = None) -> Column:
    """Parse JSON text with a fixed schema in permissive mode.

    Bad input (not JSON, empty, null, truncated, a top-level array) gives a
    struct of nulls; a field of the wrong type becomes null on its own.
    With `corrupt_column` the raw text of unparsable records is kept in
    that extra string field instead of being lost silently.
    """
    c = col(c) if isinstance(c, str) else c
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not corrupt_column:
        # Default (permissive) mode and no options: Catalyst can then prune
        # the parsed schema to the fields a query actually reads.
        return F.from_json(c, schema)
    schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
    return F.from_json(c, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column})


def key_fields(schema: T.StructType, key: Sequence[str]) -> list[str]:
    """The schema's own spelling of the key fields, matched exactly or else by case-folding."""
    by_lower = {f.name.lower(): f.name for f in schema.fields}
    names = []
    for k in key:
        if k not in schema.fieldNames() and k.lower() not in by_lower:
            raise ValueError(f"key {k!r} is not a field of the payload schema")
        names.append(k if k in schema.fieldNames() else by_lower[k.lower()])
    return names


def is_json_object(c: str | Column) -> Column:
    """Whether the text is one JSON object; false for null, junk, truncated text and other JSON values."""
    c = col(c) if isinstance(c, str) else c
    return F.coalesce(F.startswith(F.ltrim(F.get_json_object(c, "$")), F.lit("{")), F.lit(False))


def flatten_struct(df: DataFrame, struct_col: str, keep: list[str] | None = None) -> DataFrame:
    """`select(keep..., struct_col.*)`: expand a struct next to kept columns."""
    keep = keep or []
    return df.select(*[col(k) for k in keep], F.col(quote(struct_col) + ".*"))
