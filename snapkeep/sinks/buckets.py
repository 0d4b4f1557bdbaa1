"""Tables dealt into buckets by a key, so that joins on it need no shuffle.

Spark deals a bucketed table's rows with the hash that it shuffles by.  Two
tables with the same keys and number of buckets therefore join, and a table
groups or ranks by its keys, without an Exchange: task i reads bucket i of
each.  Spark keeps a table's buckets in the catalog only; here the caller (or
a version's log entry, see `versions`) states them, and the catalog is used in
passing: a table of that name exists while it is written or opened, and its
files do not belong to it.

Choose the number of buckets by size (one bucket is one task's input: bytes of the
table / 256 MB) and keep it: a table with another number is shuffled again.
A bucket cannot be split, so a key that holds a large share of the rows
makes its task long.  Snapshots hold few rows a key; for a table with hot or
null foreign keys use an ordinary join, which AQE can split.

Do not union bucketed frames and group the result by their keys: Spark 4.1
leaves out the shuffle, but runs a union of columnar scans by appending their
partitions, so equal keys stay apart (see `plans.incremental.merged_layers`).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.naming import col, quote


@dataclass(frozen=True)
class Buckets:
    """`count` buckets by the columns `keys`, each sorted by them."""

    keys: tuple[str, ...]
    count: int

    def __post_init__(self) -> None:
        object.__setattr__(self, "keys", (self.keys,) if isinstance(self.keys, str) else tuple(self.keys))
        if not self.keys or self.count < 1:
            raise ValueError("buckets need key columns and a count of at least 1")

    def to_dict(self) -> dict:
        return {**asdict(self), "keys": list(self.keys)}


def _table_name() -> str:
    return f"snapkeep_{uuid.uuid4().hex}"


def deal(df: DataFrame, buckets: Buckets) -> DataFrame:
    """`df` shuffled into its buckets: partition i holds bucket i."""
    return df.repartition(buckets.count, *[col(k) for k in buckets.keys])


def write_bucketed(
    df: DataFrame, path: str, buckets: Buckets, fmt: str = "parquet", options: Mapping[str, str] | None = None,
    dealt: bool = False,
) -> None:
    """Write `df` to the fresh folder `path`, one file a bucket.

    `dealt` says that the frame's tasks already hold whole buckets (the result
    of `deal`, or of joins and windows on the keys over tables so dealt);
    otherwise it is shuffled first.  If it does not hold, the table is still
    right, with more files a bucket.
    """
    name = _table_name()
    ready = df if dealt else deal(df, buckets)
    try:
        (
            ready.write.format(fmt).options(**dict(options or {})).option("path", path)
            .bucketBy(buckets.count, *buckets.keys).sortBy(*buckets.keys).saveAsTable(name)
        )
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType | str, buckets: Buckets, fmt: str = "parquet"
) -> DataFrame:
    """The frame of a folder that `write_bucketed` wrote, buckets known to the planner."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    keys = ", ".join(quote(k) for k in buckets.keys)
    name = _table_name()
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING {fmt} CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {buckets.count} BUCKETS LOCATION '{path.replace(chr(39), chr(92) + chr(39))}'"
    )
    try:
        # the frame holds the opened relation; the catalog entry is not needed any more
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
