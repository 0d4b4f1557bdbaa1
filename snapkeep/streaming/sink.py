"""Streaming: decode messages on a stream and append them to files.

File sinks take only the ``append`` output mode; Spark rejects the others
when the query starts.  Output is exactly-once through the checkpoint's
commit log: a rerun on the same checkpoint adds nothing already committed.  A trigger is always set; ``available_now`` processes
what is there in bounded micro-batches and stops.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.naming import lowercase_partitions


def read_stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """File stream with a fixed schema (a glob in `path` selects files)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    output_mode: str = "append",
    trigger: Mapping[str, object] | None = None,
    partition_by: Sequence[str] = (),
    query_name: str | None = None,
    wait: bool = True,
    timeout: float | None = None,
) -> StreamingQuery:
    """Append a streaming frame to files under `path` with a checkpoint.

    `trigger` defaults to ``{"availableNow": True}``; pass
    ``{"processingTime": "1 minute"}`` for a continuously running job.
    With `wait` the call blocks until the query stops and re-raises its
    failure; if `timeout` seconds pass first it raises `TimeoutError` and
    leaves the query running, so an incomplete result is never taken for a
    complete one.
    """
    parts: list[str] = []
    if partition_by:
        df, parts = lowercase_partitions(df, partition_by)
    w = (
        df.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode(output_mode)
        .trigger(**dict(trigger or {"availableNow": True}))
    )
    if parts:
        w = w.partitionBy(*parts)
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    if wait:
        ended = q.awaitTermination(timeout)
        exc = q.exception()
        if exc is not None:
            raise exc
        if timeout is not None and not ended:
            raise TimeoutError(f"the stream to {path} is still running after {timeout} s")
    return q
