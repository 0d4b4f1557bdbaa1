"""Offset ledger: how far a table has read each topic partition.

Every committed version of a table (see `sinks.versions`) records the offsets
its slice of the topic began and ended at.  The next run starts where the
last one ended, so messages are read once; the record is committed together
with the rows it stands for, so neither can be there without the other.

A slice that begins above the recorded end lost messages: they expired before
they were read.  A bounded topic read with ``failOnDataLoss=false`` skips them
without a word; `check_slice` finds them and fails the run before anything is
written.  Offsets missing inside a slice are normal on a compacted or
transactional topic, so they are counted always and fail the run only on
request (``dense=True``).

Numbers come to the driver per topic partition, never per message.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.versions import LOG, read_version

#: {topic: {partition: first offset not read yet}}
Ends = dict[str, dict[int, int]]

#: The connector's number for "the earliest offset there is".
EARLIEST = -2


class OffsetGap(RuntimeError):
    """Messages between the recorded end and the slice are missing."""


@dataclass(frozen=True)
class PartitionSlice:
    """What one run read of one topic partition: offsets in [start, end)."""

    topic: str
    partition: int
    start: int
    end: int
    n_rows: int
    #: offsets below the first message read, above the recorded end
    lost: int
    #: offsets without a message between the first and the last one read
    holes: int


def recorded_ends(spark: SparkSession, root: str) -> Ends:
    """Where the next run starts, from the table's last version; {} before the first."""
    entry = read_version(spark, root)
    return {t: {int(p): int(o) for p, o in ps.items()} for t, ps in ((entry or {}).get("ends") or {}).items()}


def starting_offsets(ends: Ends, partitions: Mapping[str, Iterable[int]] | None = None) -> str | dict:
    """`starting_offsets` for `topic_options`: the recorded ends.

    The connector wants every partition of a topic named once one is; name
    them in `partitions`, those without a record start at the earliest offset.
    """
    if not ends:
        return "earliest"
    out = {t: dict(ps) for t, ps in ends.items()}
    for topic, numbers in (partitions or {}).items():
        for p in numbers:
            out.setdefault(topic, {}).setdefault(int(p), EARLIEST)
    return out


def _end_of(ends: Ends) -> Column:
    """The recorded end of the row's topic and partition, or null."""
    pairs = [(f"{p}:{t}", o) for t, ps in ends.items() for p, o in ps.items()]
    table = F.create_map(*[F.lit(v) for pair in pairs for v in (pair[0], int(pair[1]))])
    return F.element_at(table, F.concat_ws(":", F.col("partition").cast("string"), F.col("topic")))


def unread(envelope: DataFrame, ends: Ends) -> DataFrame:
    """The messages at or above the recorded ends (all of unrecorded partitions).

    For frames that stand in for a topic, or a topic read from its earliest
    offset; a topic read from `starting_offsets` holds no others.
    """
    if not any(ends.values()):
        return envelope
    return envelope.where(F.col("offset") >= F.coalesce(_end_of(ends), F.lit(-1).cast("long")))


def slice_report(messages: DataFrame, ends: Ends) -> list[PartitionSlice]:
    """One entry for each topic partition in the slice (a map-side aggregate)."""
    rows = (
        messages.groupBy("topic", "partition")
        .agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("n"))
        .orderBy("topic", "partition").collect()
    )
    out = []
    for r in rows:
        start = ends.get(r["topic"], {}).get(r["partition"])
        lost = 0 if start is None else max(0, r["first"] - start)
        out.append(PartitionSlice(
            r["topic"], r["partition"], r["first"] if start is None else start, r["last"] + 1, r["n"], lost,
            r["last"] - r["first"] + 1 - r["n"],
        ))
    return out


def check_slice(report: Iterable[PartitionSlice], dense: bool = False) -> None:
    """Raise `OffsetGap` if messages were lost (or, `dense`, any offset is missing)."""
    bad = [s for s in report if s.lost or (dense and s.holes)]
    if bad:
        told = "; ".join(
            f"{s.topic}-{s.partition}: read up to {s.start}, the slice begins at {s.start + s.lost}, {s.holes} offsets missing inside"
            for s in bad[:20]
        )
        raise OffsetGap(f"{len(bad)} topic partitions have gaps: {told}")


def next_ends(ends: Ends, report: Iterable[PartitionSlice]) -> Ends:
    """The recorded ends after the slice; partitions without messages keep theirs."""
    out = {t: dict(ps) for t, ps in ends.items()}
    for s in report:
        mine = out.setdefault(s.topic, {})
        mine[s.partition] = max(s.end, mine.get(s.partition, 0))
    return out


def facts(ends: Ends, report: Iterable[PartitionSlice]) -> dict:
    """The ledger's part of a version's log entry."""
    return {"ends": {t: {str(p): o for p, o in ps.items()} for t, ps in ends.items()}, "slices": [asdict(s) for s in report]}


_ENTRY = (
    "version long, slices array<struct<topic string, partition int, start long, end long, n_rows long, lost long, holes long>>"
)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """All recorded slices: version, topic, partition, start_offset, end_offset, n_rows, n_lost, n_holes."""
    entries = spark.read.schema(_ENTRY).json(f"{root.rstrip('/')}/{LOG}")
    s = entries.select("version", F.explode("slices").alias("s"))
    return s.select(
        "version", "s.topic", "s.partition", F.col("s.start").alias("start_offset"), F.col("s.end").alias("end_offset"),
        F.col("s.n_rows").alias("n_rows"), F.col("s.lost").alias("n_lost"), F.col("s.holes").alias("n_holes"),
    )
