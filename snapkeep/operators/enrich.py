"""Left-outer enrichment of one entity by columns of lookup tables.

Each lookup's id column is renamed to the entity's foreign-key name and only
the wanted columns are kept, so the join is on one shared column name and
the key appears once in the output.

Join strategy is left to Spark: a lookup below
``spark.sql.autoBroadcastJoinThreshold`` (static estimate) or below the AQE
threshold (actual size at runtime) is broadcast; anything larger is a
sort-merge join.  No broadcast hint is given, so a lookup that grows with
the data is never forced into driver and executor memory.  A hot foreign
key (or many null keys) on the entity side lands in one shuffle partition;
AQE's skew-join handling splits that partition of the left side and
replicates the matching lookup rows, which is valid for a left outer join.

Null keys never match: such rows are kept with null lookup columns.  A key
repeated in a lookup multiplies the entity row; ``unique=True`` turns that
into a job failure instead, checked inside the plan (the grouping it needs
shuffles the lookup on the join key, which the join then reuses).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import col, resolve_name

_COUNT = "__snapkeep_n"


@dataclass(frozen=True)
class Lookup:
    """A lookup table joined on its `key` column, renamed to `on`."""

    frame: DataFrame
    key: str
    on: str
    columns: Sequence[str] = field(default_factory=tuple)
    unique: bool = False

    def prepared(self) -> DataFrame:
        df = self.frame
        key = resolve_name(df, self.key)
        cols = [resolve_name(df, c) for c in self.columns]
        df = df.select(col(key).alias(self.on), *[col(c) for c in cols])
        if not self.unique:
            return df
        return unique_by_key(df, self.on)


def unique_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per `key`, failing the job if any key repeats."""
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(col(key)).agg(
        F.count(F.lit(1)).alias(_COUNT), *[F.any_value(col(c)).alias(c) for c in others]
    )
    msg = F.concat(F.lit(f"duplicate lookup key in {key!r}: "), col(key).cast("string"))
    # A filter keeps the grouping's partitioning, so the join reuses it.
    checked = grouped.where(F.when(F.col(_COUNT) == 1, F.lit(True)).otherwise(F.raise_error(msg)))
    return checked.drop(_COUNT)


def enrich(entity: DataFrame, lookups: Sequence[Lookup], how: str = "left_outer") -> DataFrame:
    """Join each lookup in turn (left outer by default)."""
    out = entity
    for lk in lookups:
        on = resolve_name(out, lk.on)
        right = lk.prepared()
        if on != lk.on:
            right = right.withColumnRenamed(lk.on, on)
        out = out.join(right, on=[on], how=how)
    return out
