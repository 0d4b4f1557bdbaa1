"""Topic extract: envelope -> latest record per payload key -> dated partition.

Physical shape (rank form, late decode, the default): one scan of the topic
or envelope files; a narrow projection that casts the envelope and reads
only the key field(s) out of each JSON message (Catalyst prunes the
``from_json`` schema to them); a map-side partial ``WindowGroupLimit`` per
key; one shuffle of the surviving raw messages by key; the final window;
then the full JSON decode of the survivors only, written straight from the
window's tasks.  All rows of one extract carry the same day and the
compaction's shuffle already spreads them over AQE-sized tasks, so each
task writes one file of the day and no second shuffle is needed.  A retained change topic holds
many messages per key, so most messages are never fully decoded and the
sort and shuffle carry one text column instead of every payload field.
``decode="early"`` decodes every message first (the order of the original
job); both give the same rows.

Row counts of the input and of the null-key rows are collected with
``observe`` during the write job: no second pass over the data, unlike
counting actions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import envelope_columns, exact_int
from ..functions.json import key_fields, parse_json
from ..functions.naming import col
from ..operators.latest import latest_per_key, observe_dropped
from ..operators.layout import drop_stable, stable
from ..sinks.tables import write_table
from ..sources.parquet import day_literal
from .quarantine import quarantine

_PARSED = "__snapkeep_value"


def decode_envelope(
    envelope: DataFrame,
    schema: T.StructType | str,
    keep: Sequence[str] = ("offset", "key"),
    strict_int: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Cast the envelope and expand the JSON payload into typed columns.

    Output: the `keep` envelope columns (``offset`` as BIGINT, ``key`` as
    text; ``partition``/``topic``/``timestamp`` may be added) followed by the
    payload fields.  Messages that are not JSON objects (junk, tombstones)
    yield all-null payload fields.
    """
    extra = [c for c in keep if c not in ("offset", "key", "value")]
    cast = envelope.select(*envelope_columns(strict_int=strict_int), *[col(c) for c in extra])
    parsed = cast.select(
        *[col(c) for c in keep], parse_json("value", schema, corrupt_column).alias(_PARSED)
    )
    return parsed.select(*[col(c) for c in keep], F.col(f"{_PARSED}.*"))


def stamp_date(df: DataFrame, date_col: str, day: str | dt.date | None) -> DataFrame:
    """Add the processing date; a fixed `day` makes reruns reproducible."""
    return df.withColumn(date_col, day_literal(day) if day is not None else F.current_date())


_KEY = "__snapkeep_key_"


def _prepared(envelope, schema, key, keep_ties: bool, stable_input: bool, decode: str):
    """Rows entering the compaction and the key columns to compact on.

    ``early``: decoded records, keyed by the payload columns.  ``late``: the
    cast envelope (offset, key, value text) plus the key field(s) parsed out
    of the message under temporary names.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    keys = [key] if isinstance(key, str) else list(key)
    keep = ("offset", "key") if keep_ties else ("offset", "key", "partition")
    clash = sorted({f.name for f in schema.fields if f.name.lower() in keep})
    if clash:
        raise ValueError(f"payload fields {clash} clash with the envelope columns {list(keep)}; rename them")
    if decode == "early":
        rows, key_cols = decode_envelope(envelope, schema, keep=keep), keys
    elif decode == "late":
        names = key_fields(schema, keys)
        key_schema = T.StructType([schema[n] for n in names])
        extra = [col(c) for c in keep if c not in ("offset", "key")]
        rows = envelope.select(*envelope_columns(), *extra)
        parsed = parse_json("value", key_schema)
        if len(names) == 1:
            rows = rows.withColumn(f"{_KEY}0", parsed.getField(names[0]))
        else:
            # A generator's columns are not expanded into their uses, so each
            # message is parsed once for all key fields (one row in, one out).
            rows = rows.select("*", F.inline(F.array(parsed)).alias(*[f"{_KEY}{i}" for i in range(len(names))]))
        key_cols = [f"{_KEY}{i}" for i in range(len(names))]
    else:
        raise ValueError(f"unknown decode {decode!r}")
    return (stable(rows) if stable_input else rows), key_cols


def _snapshot_of(
    rows: DataFrame, key_cols, schema, extract_date, keep_ties: bool, method: str, date_col: str,
    decode: str, strict_int: bool = False,
) -> tuple[DataFrame, Observation]:
    observed, obs = observe_dropped(rows, key_cols, "offset", name="extract_input")
    latest = latest_per_key(
        observed, key_cols, "offset", keep_ties=keep_ties,
        tiebreak=None if keep_ties else ["partition"], method=method,
    )
    if decode == "late":
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        latest = latest.select(
            "offset", "key", parse_json("value", schema).alias(_PARSED)
        ).select("offset", "key", F.col(f"{_PARSED}.*"))
    elif not keep_ties:
        latest = latest.drop("partition")
    if strict_int:
        # Narrow only the output: the winners were chosen on 64-bit offsets.
        latest = latest.withColumn("offset", exact_int(F.col("offset"), "offset"))
    return stamp_date(latest, date_col, extract_date), obs


def latest_snapshot(
    envelope: DataFrame,
    schema: T.StructType | str,
    key: str | Sequence[str],
    extract_date: str | dt.date | None = None,
    keep_ties: bool = True,
    method: str = "rank",
    date_col: str = "EXTRACT_DATE",
    stable_input: bool = False,
    decode: str = "late",
    strict_int: bool = False,
) -> tuple[DataFrame, Observation]:
    """The latest decoded record per payload key, stamped with the extract date.

    Output columns: ``offset``, ``key``, the payload fields, `date_col`.
    ``keep_ties=False`` breaks equal offsets (one key in two topic
    partitions) by the higher partition number.  ``stable_input`` writes
    the prepared input to the shared checkpoint folder first, so retries
    after an executor loss never re-read the topic (whose old offsets may
    have expired meanwhile).  The join form reads its input twice, and both
    reads must see the same messages, so it always does this.
    ``strict_int=True`` narrows the output ``offset`` to INT and fails the
    job past 2^31-1; the compaction itself compares 64-bit offsets.
    """
    rows, key_cols = _prepared(envelope, schema, key, keep_ties, stable_input or method == "join", decode)
    return _snapshot_of(rows, key_cols, schema, extract_date, keep_ties, method, date_col, decode, strict_int)


def extract_snapshot(
    envelope: DataFrame,
    schema: T.StructType | str,
    key: str | Sequence[str],
    out_root: str,
    extract_date: str | dt.date | None = None,
    keep_ties: bool = True,
    method: str = "rank",
    date_col: str = "EXTRACT_DATE",
    output_partitions: int | None = None,
    layout: str | None = None,
    stable_input: bool = False,
    decode: str = "late",
    strict_int: bool = False,
    quarantine_root: str | None = None,
) -> dict[str, int]:
    """Write the latest snapshot as one date partition of `out_root`.

    The write overwrites only the day it carries (dynamic partition
    overwrite), so a rerun for a day is idempotent and leaves other days
    alone.  Returns the row metrics of the run.  A checkpoint of the input
    (`stable_input`, or the join form) is deleted after the write.

    `output_partitions` caps the files of the day: the decoded rows pass a
    round-robin shuffle into that many write tasks, so the compaction and the
    decode keep theirs.  `layout` picks another shape (see
    `operators.layout.shape_output`); the default writes from the compaction's
    own tasks.

    `quarantine_root` keeps the messages that the compaction drops as a dated
    partition of their own (see `quarantine`); the metrics then count them by
    reason, and `input_rows` counts all messages.
    """
    sorted_messages = None
    if quarantine_root:
        sorted_messages = quarantine(envelope, schema, key, quarantine_root, extract_date, date_col)
        envelope, stable_input = sorted_messages.accepted, False
    held = stable_input or method == "join"
    rows, key_cols = _prepared(envelope, schema, key, keep_ties, held, decode)
    snap, obs = _snapshot_of(rows, key_cols, schema, extract_date, keep_ties, method, date_col, decode, strict_int)
    out_obs = Observation("extract_output")
    snap = snap.observe(out_obs, F.count(F.lit(1)).alias("output_rows"))
    if layout is None:
        layout = "repartition" if output_partitions else "none"
    try:
        write_table(
            snap, out_root, fmt="parquet", mode="overwrite", partition_by=[date_col],
            overwrite="dynamic", partitions=output_partitions, layout=layout,
        )
    finally:
        if held:
            drop_stable(rows)
        if sorted_messages:
            sorted_messages.remove()
    return {**obs.get, **out_obs.get, **(sorted_messages.counts if sorted_messages else {})}
