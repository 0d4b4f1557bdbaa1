"""Entity enrichment: truncate codes, left-join lookups, cast dates, project."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.casts import with_date_from
from ..functions.codes import truncate_codes
from ..functions.naming import col
from ..operators.enrich import Lookup, enrich
from ..sources.parquet import read_snapshot


def enrich_entity(
    entity: DataFrame,
    lookups: Sequence[Lookup],
    codes: Sequence[str] = (),
    dates: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    code_length: int = 5,
) -> DataFrame:
    """One projection for the code prefixes, the left joins, the date casts
    (``{target: source}``, replacing a same-named column) and a final select."""
    out = truncate_codes(entity, codes, code_length) if codes else entity
    out = enrich(out, lookups)
    for target, source in (dates or {}).items():
        out = with_date_from(out, target, source)
    if columns is not None:
        out = out.select(*[col(c) for c in columns])
    return out


def enrich_from_lake(
    spark: SparkSession,
    entity_root: str,
    day: str | dt.date,
    lookups: Sequence[Mapping[str, object]],
    date_col: str = "extract_date",
    **kw,
) -> DataFrame:
    """`enrich_entity` over snapshot lakes, each read at its own as-of day.

    A lookup is given as ``{"root", "key", "on", "columns"}`` with an optional
    ``"day"`` (default: the entity's) and ``"unique"``.  Each read filters its
    partition column, so only that day's directory is listed and scanned.
    """
    def table(x: Mapping[str, object]) -> DataFrame:
        return read_snapshot(spark, str(x["root"]), x.get("day") or day, partition_col=date_col)

    return enrich_entity(
        read_snapshot(spark, entity_root, day, partition_col=date_col),
        [
            Lookup(table(x), key=x["key"], on=x["on"], columns=list(x["columns"]), unique=bool(x.get("unique", False)))
            for x in lookups
        ],
        **kw,
    )
