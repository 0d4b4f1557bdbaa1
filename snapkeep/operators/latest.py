"""Latest record per key (change-record compaction).

Contract:

* rows whose key or order value is null are dropped first (unparsable and
  tombstone messages decode to a null key, so they vanish here);
* ``keep_ties=True`` keeps every row sharing a key and its highest order
  value (message offsets are per topic partition, so one key can tie
  across partitions);
* ``keep_ties=False`` keeps one row per key, breaking ties by the
  `tiebreak` columns (highest wins; by default all other columns).

Two physical forms:

* ``method="rank"``: ``rank()``/``row_number()`` over the key,
  filtered to 1.  Catalyst turns this into a partial ``WindowGroupLimit``
  before the shuffle, so each map task forwards only its own top rows per
  key: a key holding a third of all rows still shuffles at most one
  (tied) group per map task.  One scan, one shuffle.  The rows tied at a
  key's maximum meet in one task, so it is the default only where one row
  is kept (``keep_ties=False``) and the form to pick where few rows tie, as
  message offsets do.
* ``method="join"`` (default with ``keep_ties=True`` on one order column):
  the grouped maximum joined back on (key, order).  It
  scans twice, but when the key count is small AQE turns the join into a
  broadcast of the (small, size-checked) maxima and the big side is never
  shuffled; otherwise AQE splits a skewed (key, order).  Ties are always
  kept, however many rows tie.
* ``method="aggregate"`` (``keep_ties=False`` only): ``max_by`` of the whole
  row over (order, tiebreak), combined on the map side: one row for each key
  and map task is shuffled, and no task holds more than one row of a key at a
  time.  Spark aggregates values of variable size over rows sorted by the
  grouping key, so the map side sorts as the window form does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import col, resolve_name

_RANK = "__snapkeep_rank"


def _as_list(x: str | Sequence[str] | None) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def not_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond: Column | None = None
    for c in columns:
        e = col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df if cond is None else df.where(cond)


def max_per_key(df: DataFrame, key: str | Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """``groupBy(key).agg(max(value))``; partial aggregation runs map-side."""
    keys = [resolve_name(df, k) for k in _as_list(key)]
    v = resolve_name(df, value)
    return df.groupBy(*[col(k) for k in keys]).agg(F.max(col(v)).alias(alias or v))


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    keep_ties: bool = True,
    tiebreak: str | Sequence[str] | None = None,
    method: str | None = None,
    known_not_null: bool = False,
) -> DataFrame:
    """Rows with the highest `order` value for each `key` (see module doc).

    `known_not_null` leaves out the filter for null keys and orders where the
    rows are known to have none.
    """
    keys = [resolve_name(df, k) for k in _as_list(key)]
    orders = [resolve_name(df, o) for o in _as_list(order)]
    ties = [resolve_name(df, t) for t in _as_list(tiebreak)]
    if not keys or not orders:
        raise ValueError("key and order are required")
    base = df if known_not_null else not_null_rows(df, keys + orders)
    if method is None:
        method = "join" if keep_ties and len(orders) == 1 else "rank"

    if method == "join":
        if not keep_ties:
            raise ValueError("method='join' always keeps ties; use method='rank'")
        if len(orders) != 1:
            raise ValueError("method='join' takes one order column")
        top = max_per_key(base, keys, orders[0])
        # Joining on (key, order) spreads a hot key over many partitions.
        return base.join(top, on=keys + orders, how="inner").select(*[col(c) for c in df.columns])

    if method not in ("rank", "aggregate"):
        raise ValueError(f"unknown method {method!r}")
    if not keep_ties and not ties:
        # Without an explicit tiebreak every other orderable column breaks
        # ties, so the pick is deterministic (a recomputed task after an
        # executor loss picks the same row).
        ties = [
            f.name for f in df.schema.fields
            if f.name not in keys + orders and not isinstance(f.dataType, T.MapType)
        ]
    if method == "aggregate":
        if keep_ties:
            raise ValueError("method='aggregate' keeps one row per key; use keep_ties=False")
        # Structs compare field by field with nulls lowest, as the window's order does.
        best = F.max_by(F.struct(*[col(c) for c in df.columns]), F.struct(*[col(c) for c in orders + ties]))
        top = base.groupBy(*[col(k).alias(f"{_RANK}_{i}") for i, k in enumerate(keys)]).agg(best.alias(_RANK))
        return top.select(*[F.col(_RANK).getField(c).alias(c) for c in df.columns])
    order_by = [col(o).desc() for o in orders]
    if keep_ties:
        fn = F.rank()
    else:
        order_by += [col(t).desc_nulls_last() for t in ties]
        fn = F.row_number()
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order_by)
    return base.withColumn(_RANK, fn.over(w)).where(F.col(_RANK) == 1).drop(_RANK)


def observe_dropped(
    df: DataFrame, key: str | Sequence[str], order: str | Sequence[str], name: str = "latest_input"
) -> tuple[DataFrame, Observation]:
    """Attach row metrics to `df`, gathered during the job that consumes it.

    Reports the input row count and the rows the compaction drops for a null
    key or order value.  No extra Spark job is run: the counts ride along
    with the action (write, count) that executes the plan.
    """
    keys = [resolve_name(df, k) for k in _as_list(key)]
    orders = [resolve_name(df, o) for o in _as_list(order)]
    null_key: Column = F.lit(False)
    for k in keys:
        null_key = null_key | col(k).isNull()
    null_order: Column = F.lit(False)
    for o in orders:
        null_order = null_order | col(o).isNull()
    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(null_key).alias("null_key_rows"),
        F.count_if(~null_key & null_order).alias("null_order_rows"),
    )
    return observed, obs
