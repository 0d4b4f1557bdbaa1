"""Rejected messages: kept beside the snapshot instead of lost.

The compaction drops messages that have no usable key: junk, tombstones,
records without the key field or without an offset.  `quarantine` reads the
topic once and deals every message to one of two folders by what is wrong with it;
the rejected ones become a dated partition of their own table, with the reason
and the raw text, and the others are read back for the compaction.  The topic
is not read twice, so both sinks see the same messages even if some expire
meanwhile, and every message is in exactly one of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import envelope_columns
from ..functions.json import is_json_object, key_fields, parse_json
from ..session import remove_path, scratch_path
from ..sinks.tables import write_table
from ..sources.parquet import day_literal

#: Why a message is rejected, the first that holds.
REASONS = ("tombstone", "not_json", "no_key", "no_offset")
REASON = "reason"
_REJECTED = "rejected"


@dataclass
class SortedMessages:
    """The accepted messages (envelope columns) and the rejected ones' counts."""

    accepted: DataFrame
    counts: dict[str, int]
    path: str

    def remove(self) -> None:
        """Delete the folder behind `accepted`, which cannot be read afterwards."""
        remove_path(self.accepted.sparkSession, self.path)


def classify(envelope: DataFrame, schema: T.StructType | str, key: str | Sequence[str]) -> DataFrame:
    """The cast messages with their `reason` for rejection, null if accepted.

    Only the key fields are parsed.  A key field of the wrong type is no key.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = key_fields(schema, [key] if isinstance(key, str) else list(key))
    parsed = parse_json("value", T.StructType([schema[n] for n in names]))
    no_key = F.lit(False)
    for n in names:
        no_key = no_key | parsed.getField(n).isNull()
    rows = envelope.select("topic", "partition", *envelope_columns())
    return rows.withColumn(
        REASON,
        F.when(F.col("value").isNull(), F.lit("tombstone"))
        .when(~is_json_object("value"), F.lit("not_json"))
        .when(no_key, F.lit("no_key"))
        .when(F.col("offset").isNull(), F.lit("no_offset")),
    )


def quarantine(
    envelope: DataFrame, schema: T.StructType | str, key: str | Sequence[str], quarantine_root: str,
    extract_date: str | dt.date | None = None, date_col: str = "EXTRACT_DATE",
) -> SortedMessages:
    """Write the rejected messages as the day's partition of `quarantine_root`.

    A rerun replaces the day, also when it rejects nothing.  The staged messages lie in the shared
    checkpoint folder until `remove`.
    """
    spark = envelope.sparkSession
    staged = scratch_path(spark, "sorted-messages")
    seen = Observation("sorted_messages")
    rows = classify(envelope, schema, key)
    counts = [F.count_if(F.col(REASON) == r).alias(r) for r in REASONS]
    rows = rows.observe(seen, F.count(F.lit(1)).alias("input_rows"), *counts)
    write_table(rows.withColumn(_REJECTED, F.col(REASON).isNotNull()), staged, partition_by=[_REJECTED], layout="none")
    read = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(_REJECTED, T.BooleanType())])).parquet(staged)
    day = day_literal(extract_date) if extract_date is not None else F.current_date()
    bad = read.where(_REJECTED).drop(_REJECTED).withColumn(date_col, day)
    got = dict(seen.get)
    if sum(got[r] for r in REASONS):
        # the staged tasks' files are small parts of the input: evened out by size
        write_table(bad, quarantine_root, mode="overwrite", partition_by=[date_col])
    else:
        _clear_day(bad, quarantine_root, extract_date, date_col)
    return SortedMessages(read.where(~F.col(_REJECTED)).drop(_REJECTED, REASON), got, staged)


def _clear_day(bad: DataFrame, root: str, extract_date: str | dt.date | None, date_col: str) -> None:
    """Dynamic overwrite replaces only days that have rows; a rerun that rejects
    nothing must not leave the day's old rejects."""
    day = extract_date or bad.sparkSession.range(1).select(F.current_date()).first()[0]
    remove_path(bad.sparkSession, f"{root.rstrip('/')}/{date_col.lower()}={day}")
