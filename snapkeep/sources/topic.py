"""Bounded reads of a message topic (Kafka source) and offset slices.

The Kafka connector is a separate package; when it is missing on the
classpath `read_topic` raises a clear error.  Any frame in the envelope
schema (`schemas.ENVELOPE`) can stand in for a topic read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values (must match the reference job's source options): read the
# whole retained topic, skip expired offsets silently, authenticate with SASL
# PLAIN over TLS using the standard PLAIN login module.
DEFAULT_STARTING_OFFSETS = "earliest"
DEFAULT_ENDING_OFFSETS = "latest"
DEFAULT_FAIL_ON_DATA_LOSS = False
DEFAULT_SECURITY_PROTOCOL = "SASL_SSL"
DEFAULT_SASL_MECHANISM = "PLAIN"
PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def topic_options(
    brokers: str,
    topic: str | None = None,
    username: str | None = None,
    password: str | None = None,
    starting_offsets: str | Mapping = DEFAULT_STARTING_OFFSETS,
    ending_offsets: str | Mapping = DEFAULT_ENDING_OFFSETS,
    assign: str | Mapping | None = None,
    fail_on_data_loss: bool = DEFAULT_FAIL_ON_DATA_LOSS,
    security_protocol: str | None = DEFAULT_SECURITY_PROTOCOL,
    sasl_mechanism: str = DEFAULT_SASL_MECHANISM,
    min_partitions: int | None = None,
    max_records_per_partition: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Option map for a bounded topic read.

    Either `topic` (subscribe) or `assign` (explicit partitions) selects the
    input; offsets take ``earliest``/``latest`` or per-partition JSON, given
    as text or as a mapping ``{topic: {partition: offset}}``.  The start is
    inclusive, the end exclusive.  ``fail_on_data_loss=False`` skips offsets
    the broker has already expired, without error.

    Read parallelism is one task per topic partition unless
    `min_partitions` (split big partitions into at least that many tasks
    overall) or `max_records_per_partition` (cap records per task) is set;
    for a large retained topic set one of them so the scan spreads over the
    cluster instead of a handful of tasks.
    """
    if (topic is None) == (assign is None):
        raise ValueError("give exactly one of topic or assign")

    def text(v: str | Mapping) -> str:
        return v if isinstance(v, str) else json.dumps({t: {str(p): int(o) for p, o in m.items()} for t, m in v.items()})

    opts: dict[str, str] = {"kafka.bootstrap.servers": brokers}
    if topic is not None:
        opts["subscribe"] = topic
    else:
        opts["assign"] = assign if isinstance(assign, str) else json.dumps({t: list(ps) for t, ps in assign.items()})
    opts["startingOffsets"] = text(starting_offsets)
    opts["endingOffsets"] = text(ending_offsets)
    opts["failOnDataLoss"] = "true" if fail_on_data_loss else "false"
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    if max_records_per_partition:
        opts["maxRecordsPerPartition"] = str(int(max_records_per_partition))
    if security_protocol:
        opts["kafka.security.protocol"] = security_protocol
        opts["kafka.sasl.mechanism"] = sasl_mechanism
        if username is not None:
            user = json.dumps(username)
            pwd = json.dumps(password or "")
            opts["kafka.sasl.jaas.config"] = f"{PLAIN_LOGIN_MODULE} required username={user} password={pwd};"
    opts.update(extra or {})
    return opts


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """``spark.read.format("kafka")`` over the option map (a bounded batch read).

    Each Kafka partition becomes at least one Spark task (raise
    ``minPartitions`` in `options` to split big partitions further).
    """
    try:
        return spark.read.format("kafka").options(**dict(options)).load()
    except Exception as e:  # connector jar not on the classpath
        msg = str(e).lower()
        if "kafka" in msg and ("find data source" in msg or "data_source_not_found" in msg):
            raise RuntimeError(
                "the Kafka source is not installed; add the spark-sql-kafka package to the session"
            ) from e
        raise


def read_topic_stream(spark: SparkSession, options: Mapping[str, str], max_offsets_per_trigger: int | None = None) -> DataFrame:
    """``spark.readStream.format("kafka")``: the topic as an unbounded envelope frame.

    Decode it with `plans.decode_envelope` and append it with
    `streaming.write_stream`.  ``endingOffsets`` does not apply to streams
    and is dropped; `max_offsets_per_trigger` bounds each micro-batch.
    """
    opts = {k: v for k, v in dict(options).items() if k != "endingOffsets"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    try:
        return spark.readStream.format("kafka").options(**opts).load()
    except Exception as e:
        msg = str(e).lower()
        if "kafka" in msg and ("find data source" in msg or "data_source_not_found" in msg):
            raise RuntimeError(
                "the Kafka source is not installed; add the spark-sql-kafka package to the session"
            ) from e
        raise


def offset_slice(ranges: Mapping[int, tuple[int | None, int | None]]) -> Column:
    """Predicate selecting ``partition -> [start, end)`` offset ranges of an envelope.

    Mirrors explicit partition assignment with per-partition starting and
    ending offsets; ``None`` leaves a side open.
    """
    cond: Column = F.lit(False)
    for p, (start, end) in ranges.items():
        c = F.col("partition") == F.lit(int(p))
        if start is not None:
            c = c & (F.col("offset") >= F.lit(int(start)))
        if end is not None:
            c = c & (F.col("offset") < F.lit(int(end)))
        cond = cond | c
    return cond


def slice_offsets(envelope: DataFrame, ranges: Mapping[int, tuple[int | None, int | None]]) -> DataFrame:
    return envelope.where(offset_slice(ranges))
