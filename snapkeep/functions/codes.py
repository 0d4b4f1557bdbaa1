"""Code truncation and code-level fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .naming import col, resolve_name

# Fixed values (must match the reference job): codes are cut to their first
# five characters; a record with no code at any level gets the text "-1".
CODE_LENGTH = 5
MISSING_CODE = "-1"


def code_prefix(c: str | Column, length: int = CODE_LENGTH) -> Column:
    """First `length` characters as a string; shorter values pass, null stays null.

    Position 1 is the first character (a 0 start behaves the same in Spark,
    but not in other SQL engines, so it is never used here).
    """
    c = col(c) if isinstance(c, str) else c
    return F.substring(c.cast("string"), 1, length)


def truncate_codes(df: DataFrame, columns: Sequence[str], length: int = CODE_LENGTH) -> DataFrame:
    """Replace each code column, in place, by its prefix (one projection)."""
    names = [resolve_name(df, c) for c in columns]
    return df.withColumns({n: code_prefix(n, length) for n in names})


def first_code(
    columns: Sequence[str | Column], length: int = CODE_LENGTH, default: str = MISSING_CODE
) -> Column:
    """First non-null code prefix over `columns`, most specific level first.

    The fallback is the *string* ``"-1"``: mixing a string with an integer
    literal in `coalesce` would widen to a number and fail under ANSI mode.
    """
    return F.coalesce(*[code_prefix(c, length) for c in columns], F.lit(default).cast("string"))
