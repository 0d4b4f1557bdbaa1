"""Incremental compaction: a standing snapshot and the messages since the last run.

The snapshot is a versioned table (`sinks.versions`) bucketed by the record
key (`sinks.buckets`).  A run takes the messages that its ledger has not read
(`sources.ledger`), keeps the latest of each key and deals only those into the
snapshot's buckets.  They become a layer of their own: a run writes what the
slice holds, however large the snapshot is.  Readers rank the layers with the
base bucket by bucket, and the run that would exceed `max_layers` writes them
merged into one.  Both shuffle the layers since the last merge, never the base,
and full payloads are decoded for the slice's survivors only.  Rows, offsets and deletes are committed in one log
entry.  A run that fails leaves the last version; one that is repeated starts
at the same offsets.

Runs over the slices of a topic give what one run over the whole topic gives
(the latest rows by offset, ties kept or broken as in `latest_snapshot`), in
any split into slices.

Deletes (`deletes=True`): records are keyed by the envelope's key, and a
message without a value, or with `delete_flag` true in its payload, removes
its key.  The delete mark itself stays in the snapshot (`is_deleted`), so that
an older message of the key in a later slice, which a key spread over several
topic partitions can have, does not bring it back; `read_live` leaves marks
out.  Among rows tied at a key's highest offset marks vanish beside others.

Without `deletes`, records are keyed by payload fields.  In both modes messages
without a key or that are not JSON objects are dropped and counted, as in the
extract.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import envelope_columns
from ..functions.json import is_json_object, key_fields, parse_json
from ..functions.naming import col, quote
from ..operators.latest import latest_per_key
from ..operators.layout import drop_stable, stable
from ..sinks.buckets import Buckets, deal
from ..sinks.tables import write_table
from ..sinks.versions import read_folder, read_version, write_version
from ..sources import ledger
from .extract import stamp_date

#: State columns beside the payload.
SOURCE = ("topic", "partition", "offset", "key")
DELETED = "is_deleted"
_VALUE = "__snapkeep_value"
_KEYED = "__snapkeep_key"
_RECORD = "__snapkeep_record"

#: Buckets of a new snapshot, unless given: of a stream, and by the messages of the first run.
STREAM_BUCKETS = 200
MESSAGES_PER_BUCKET = 1_000_000
LEAST_BUCKETS = 8
#: Layers that a snapshot is read from at most before a run merges them.
MAX_LAYERS = 8


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def check_names(schema: T.StructType) -> None:
    taken = {*SOURCE, DELETED}
    clash = sorted(f.name for f in schema.fields if f.name.lower() in taken)
    if clash:
        raise ValueError(f"payload fields {clash} clash with the state's columns {sorted(taken)}; rename them")


def keyed_messages(
    envelope: DataFrame, schema: T.StructType, key: str | Sequence[str] | None, deletes: bool, delete_flag: str | None
) -> tuple[DataFrame, list[str]]:
    """The cast messages with their key columns and delete marks, undecoded.

    Only the key and flag fields are parsed here.  Returns the frame and the
    names of its key columns.
    """
    rows = envelope.select("topic", "partition", *envelope_columns())
    if deletes:
        mark: Column = F.col("value").isNull()
        if delete_flag:
            (flag,) = key_fields(schema, [delete_flag])
            parsed = parse_json("value", T.StructType([T.StructField(flag, T.BooleanType())])).getField(flag)
            mark = mark | F.coalesce(parsed, F.lit(False))
        # junk has a key here, but it is no record and must not replace one
        usable = F.col("value").isNull() | is_json_object("value")
        return rows.withColumn(DELETED, mark).withColumn(_KEYED, F.when(usable, F.col("key"))), [_KEYED]
    if key is None:
        raise ValueError("name the payload's key fields, or compact by the envelope's key with deletes=True")
    names = key_fields(schema, [key] if isinstance(key, str) else list(key))
    parsed = parse_json("value", T.StructType([schema[n] for n in names]))
    rows = rows.select("*", F.inline(F.array(parsed)).alias(*[f"{_VALUE}_{n}" for n in names]))
    return rows.withColumn(DELETED, F.lit(False)), [f"{_VALUE}_{n}" for n in names]


def _latest(rows: DataFrame, keys: Sequence[str], keep_ties: bool, deletes: bool, known_not_null: bool = False) -> DataFrame:
    """The key's rows at its highest offset (then partition, unless ties are kept)."""
    orders = ["offset"] if keep_ties else ["offset", "partition"]
    # topic last, so that one row is picked of equal offsets in two topics
    out = latest_per_key(
        rows, keys, orders, keep_ties=keep_ties, tiebreak=None if keep_ties else ["topic"], method="rank",
        known_not_null=known_not_null,
    )
    if keep_ties and deletes:
        # one further comparison in the same groups: marks lose against other tied rows
        marked = out.withColumn(_RECORD, ~F.col(DELETED))
        out = latest_per_key(marked, keys, _RECORD, method="rank", known_not_null=known_not_null).drop(_RECORD)
    return out


def _decoded(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Full payloads of the surviving messages."""
    v = F.when(~F.col(DELETED), F.col("value"))
    parsed = rows.select(*SOURCE, DELETED, parse_json(v, schema).alias(_VALUE))
    return parsed.select(*SOURCE, DELETED, *[F.col(_VALUE).getField(f.name).alias(f.name) for f in schema.fields])


def state_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()), T.StructField("key", T.StringType()),
        T.StructField(DELETED, T.BooleanType()), *[T.StructField(f.name, f.dataType) for f in schema.fields],
    ])


def slice_rows(
    messages: DataFrame, schema: T.StructType, message_keys: Sequence[str], keep_ties: bool, deletes: bool
) -> DataFrame:
    """The slice's latest rows, decoded; one shuffle, after a map-side limit."""
    return _decoded(_latest(messages, message_keys, keep_ties, deletes), schema)


def merged_layers(
    base: DataFrame, newer: Sequence[DataFrame], buckets: Buckets, keep_ties: bool, deletes: bool
) -> DataFrame:
    """The latest rows of a bucketed base and newer rows, ranked bucket by bucket.

    `newer` frames must not be bucketed scans: dealing them is a real shuffle
    then.  Spark 4.1 takes a union of frames dealt alike for dealt, but runs a
    union of columnar scans by appending their partitions, so that the rows of
    a bucket would not meet.
    """
    if not newer:
        return base
    both = base.unionByName(deal(reduce(DataFrame.unionByName, newer), buckets))
    # Both sides lost their null keys and offsets before.  A filter for them here
    # would hide from the planner that they are dealt alike.
    return _latest(both, buckets.keys, keep_ties, deletes, known_not_null=True)


def _standing(spark: SparkSession, root: str, entry: dict) -> tuple[DataFrame, list[DataFrame]]:
    """The base of a version, and its layers as plain files."""
    base, *newer = _layers(entry)
    return read_folder(spark, root, entry, base), [read_folder(spark, root, entry, d, bucketed=False) for d in newer]


def _layers(entry: dict | None) -> list[str]:
    """The data folders of a version, oldest first."""
    return [*(entry.get("layers") or []), entry["data"]] if entry else []


def _add_layer(
    spark: SparkSession, root: str, entry: dict | None, new: DataFrame, buckets: Buckets, keep_ties: bool, deletes: bool,
    max_layers: int, keep_versions: int, facts: dict,
) -> dict:
    """Commit the slice's rows: as a layer, or merged with all there are."""
    layers = _layers(entry)
    if len(layers) >= max(1, max_layers):
        base, newer = _standing(spark, root, entry)
        new, layers = merged_layers(base, [*newer, new], buckets, keep_ties, deletes), []
    else:
        new = deal(new, buckets)
    return write_version(
        new, root, expected=entry["version"] if entry else 0, buckets=buckets, dealt=True, keep=keep_versions,
        facts={**facts, "layers": layers, "keep_ties": keep_ties, "deletes": deletes},
    )


def compact(
    envelope: DataFrame,
    schema: T.StructType | str,
    root: str,
    key: str | Sequence[str] | None = None,
    buckets: int | None = None,
    keep_ties: bool = True,
    deletes: bool = False,
    delete_flag: str | None = None,
    dense: bool = False,
    max_layers: int = MAX_LAYERS,
    keep_versions: int = 2,
) -> dict:
    """Merge the unread messages of `envelope` into the snapshot at `root`.

    `envelope` is a topic read (from `ledger.starting_offsets`, or the whole
    retained topic) or any frame in the envelope schema.  The unread messages
    are checkpointed first: they are read three times (offsets, latest rows,
    payloads of those) and must be the same each time.  Raises
    `ledger.OffsetGap` before anything is written if messages expired unread.
    The number of buckets (by default one for each million messages of the first
    run, 8 at least) and the keys are the snapshot's own after that.  ``max_layers=1`` rewrites the snapshot with every slice.  Returns the
    run's metrics; `written_rows` are those of the layer or merged snapshot.
    """
    spark = envelope.sparkSession
    schema = _struct(schema)
    check_names(schema)
    entry = read_version(spark, root)
    version = entry["version"] if entry else 0
    ends = ledger.recorded_ends(spark, root)
    rows, message_keys = keyed_messages(ledger.unread(envelope, ends), schema, key, deletes, delete_flag)
    keys = ["key"] if deletes else [k[len(_VALUE) + 1:] for k in message_keys]
    if entry:
        plan = _same_shape(entry, keys, buckets, keep_ties, deletes, schema)
    rows = stable(rows)
    try:
        report = ledger.slice_report(rows, ends)
        ledger.check_slice(report, dense)
        if not entry:
            plan = Buckets(tuple(keys), buckets or sized_buckets(sum(s.n_rows for s in report)))
        if not report and entry:
            return {"version": version, "input_rows": 0, "null_key_rows": 0, "written_rows": 0}
        no_key = F.lit(False)
        for k in message_keys:
            no_key = no_key | col(k).isNull()
        dropped = rows.where(no_key).count()
        new = slice_rows(rows, schema, message_keys, keep_ties, deletes)
        done = _add_layer(
            spark, root, entry, new, plan, keep_ties, deletes, max_layers, keep_versions,
            {**ledger.facts(ledger.next_ends(ends, report), report), "streams": (entry or {}).get("streams") or {}},
        )
    finally:
        drop_stable(rows)
    return {"version": done["version"], "input_rows": sum(s.n_rows for s in report), "null_key_rows": dropped,
            "written_rows": done["n_rows"]}


def sized_buckets(messages: int) -> int:
    """Buckets for a snapshot whose first run has so many messages."""
    return max(LEAST_BUCKETS, -(-messages // MESSAGES_PER_BUCKET))


def _same_shape(
    entry: dict, keys: Sequence[str], buckets: int | None, keep_ties: bool, deletes: bool, schema: T.StructType
) -> Buckets:
    """The standing snapshot's buckets; an error if it was made for something else."""
    have = Buckets(**entry["buckets"])
    if have.keys != tuple(keys) or (buckets and buckets != have.count):
        raise ValueError(f"the snapshot is bucketed by {have.keys} into {have.count}, not {tuple(keys)} into {buckets or have.count}")
    if (entry["keep_ties"], entry["deletes"]) != (keep_ties, deletes):
        raise ValueError("the snapshot was made with another keep_ties or deletes")
    if T.StructType.fromJson(entry["schema"]).fieldNames() != state_schema(schema).fieldNames():
        raise ValueError("the snapshot holds other payload fields; write a new one for a changed schema")
    return have


def read_state(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The snapshot with its delete marks, dealt by its key.

    Without layers it is a scan whose buckets the planner knows; with them only
    they are shuffled.  Joins on the key need no further shuffle either way.
    """
    entry = read_version(spark, root, version)
    if entry is None:
        raise FileNotFoundError(f"{root} has no {'committed version' if version is None else f'version {version}'}")
    base, newer = _standing(spark, root, entry)
    return merged_layers(base, newer, Buckets(**entry["buckets"]), entry["keep_ties"], entry["deletes"])


def squash(spark: SparkSession, root: str, drop_marks: bool = False, keep_versions: int = 2) -> dict:
    """Write all layers merged into one now; returns the new log entry.

    `drop_marks` leaves out the delete marks.  Do that once no older message
    of a deleted key can come, that is when every key's messages stay in one
    topic partition, or all partitions have been read beyond the deletes.
    """
    entry = read_version(spark, root)
    if entry is None:
        raise FileNotFoundError(f"{root} has no committed version")
    state = read_state(spark, root, entry["version"])
    kept = ("ends", "keep_ties", "deletes", "streams")
    return write_version(
        state.where(~F.col(DELETED)) if drop_marks else state, root, expected=entry["version"],
        buckets=Buckets(**entry["buckets"]), dealt=True, keep=keep_versions,
        facts={**{k: entry[k] for k in kept}, "slices": [], "layers": []},
    )


def read_live(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The snapshot's live records: offset, key and the payload."""
    state = read_state(spark, root, version)
    return state.where(~F.col(DELETED)).select(*[
        F.col(quote(c)) for c in state.columns if c not in ("topic", "partition", DELETED)
    ])


def publish(
    spark: SparkSession, root: str, out_root: str, day: str | dt.date | None = None, date_col: str = "EXTRACT_DATE",
    version: int | None = None,
) -> None:
    """Write the live records as one date partition of a snapshot lake, as the
    extract does (only that day is replaced; no shuffle, a file for each bucket)."""
    live = stamp_date(read_live(spark, root, version), date_col, day)
    write_table(live, out_root, mode="overwrite", partition_by=[date_col], layout="none")


def live_snapshot(
    envelope: DataFrame, schema: T.StructType | str, extract_date: str | dt.date | None = None, keep_ties: bool = True,
    delete_flag: str | None = None, date_col: str = "EXTRACT_DATE",
) -> DataFrame:
    """One pass over a whole topic with deletes applied: the latest record of
    every envelope key that its last message did not delete."""
    schema = _struct(schema)
    check_names(schema)
    rows, keys = keyed_messages(envelope, schema, None, True, delete_flag)
    latest = _latest(rows, keys, keep_ties, True).where(~F.col(DELETED))
    out = _decoded(latest, schema).drop("topic", "partition", DELETED)
    return stamp_date(out, date_col, extract_date)


def apply_batch(
    messages: DataFrame, batch_id: int, stream: str, schema: T.StructType | str, root: str,
    key: str | Sequence[str] | None = None, buckets: int | None = None, keep_ties: bool = True, deletes: bool = False,
    delete_flag: str | None = None, max_layers: int = MAX_LAYERS, keep_versions: int = 2,
) -> bool:
    """Merge one micro-batch of a stream; False if it was merged before.

    The log entry that holds the batch's rows records its number, so a batch
    that a restarted query runs again is recognised and left out.
    """
    spark = messages.sparkSession
    schema = _struct(schema)
    check_names(schema)
    entry = read_version(spark, root)
    streams = dict((entry or {}).get("streams") or {})
    if streams.get(stream, -1) >= batch_id:
        return False
    rows, message_keys = keyed_messages(messages, schema, key, deletes, delete_flag)
    keys = ["key"] if deletes else [k[len(_VALUE) + 1:] for k in message_keys]
    plan = _same_shape(entry, keys, buckets, keep_ties, deletes, schema) if entry else Buckets(tuple(keys), buckets or STREAM_BUCKETS)
    new = slice_rows(rows, schema, message_keys, keep_ties, deletes)
    _add_layer(
        spark, root, entry, new, plan, keep_ties, deletes, max_layers, keep_versions,
        {"ends": (entry or {}).get("ends") or {}, "slices": [], "streams": {**streams, stream: batch_id}},
    )
    return True


__all__ = [
    "Buckets", "apply_batch", "compact", "live_snapshot", "publish", "read_live", "read_state", "squash",
]
