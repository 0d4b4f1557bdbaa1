import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from snapkeep.functions import flatten_struct, parse_json
from snapkeep.sources.topic import offset_slice, read_topic, topic_options
from snapkeep.streaming import read_stream_files, write_stream

EVENTS = "/root/testdata/sf0.001/events.parquet"
EVENTS_GLOB = "/root/testdata/sf0.001/event*.parquet"  # a file stream watches a folder or glob


def _decoded(df):
    return flatten_struct(df.select("event_id", parse_json("props", "k bigint").alias("v")), "v",
                          keep=["event_id"])


def test_stream_append_once_then_rerun_adds_nothing(spark, tmp):
    schema = spark.read.parquet(EVENTS).schema
    stream = _decoded(read_stream_files(spark, EVENTS_GLOB, schema))
    write_stream(stream, tmp + "/out", tmp + "/ck")
    n = spark.read.parquet(tmp + "/out").count()
    write_stream(_decoded(read_stream_files(spark, EVENTS_GLOB, schema)), tmp + "/out", tmp + "/ck")
    assert spark.read.parquet(tmp + "/out").count() == n
    # batch and streaming decode agree
    batch = _decoded(spark.read.parquet(EVENTS))
    back = spark.read.parquet(tmp + "/out")
    assert back.exceptAll(batch).count() == 0 and batch.exceptAll(back).count() == 0


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_file_sink_rejects_other_modes(spark, tmp, mode):
    schema = spark.read.parquet(EVENTS).schema
    stream = read_stream_files(spark, EVENTS_GLOB, schema).groupBy("event_type").count()
    with pytest.raises(AnalysisException):
        write_stream(stream, tmp + "/out", tmp + "/ck", output_mode=mode)


def test_topic_options_map():
    opts = topic_options("b:9093", topic="t", username="u", password='p"w')
    assert opts["subscribe"] == "t" and opts["kafka.bootstrap.servers"] == "b:9093"
    assert opts["startingOffsets"] == "earliest" and opts["endingOffsets"] == "latest"
    assert opts["failOnDataLoss"] == "false"
    assert opts["kafka.security.protocol"] == "SASL_SSL" and opts["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="u"' in opts["kafka.sasl.jaas.config"] and 'password="p\\"w"' in opts["kafka.sasl.jaas.config"]
    assert "enable.auto.commit" not in opts
    sliced = topic_options("b", assign={"t": [0]}, starting_offsets={"t": {0: 14886991}},
                           ending_offsets={"t": {0: 14887000}}, security_protocol=None)
    assert sliced["assign"] == '{"t": [0]}'
    assert sliced["startingOffsets"] == '{"t": {"0": 14886991}}'
    assert "kafka.sasl.jaas.config" not in sliced
    assert topic_options("b", topic="t", min_partitions=4000)["minPartitions"] == "4000"
    with pytest.raises(ValueError):
        topic_options("b")


def test_read_topic_without_connector(spark):
    with pytest.raises(RuntimeError, match="Kafka source is not installed"):
        read_topic(spark, topic_options("localhost:1", topic="t", security_protocol=None))


def test_offset_slice(spark):
    env = spark.createDataFrame([(p, o) for p in range(2) for o in range(10)], "partition int, offset bigint")
    got = env.where(offset_slice({0: (3, 6), 1: (8, None)})).collect()
    assert sorted((r[0], r[1]) for r in got) == [(0, 3), (0, 4), (0, 5), (1, 8), (1, 9)]


def test_stream_aggregate_without_watermark_rejected(spark, tmp):
    schema = spark.read.parquet(EVENTS).schema
    stream = read_stream_files(spark, EVENTS_GLOB, schema).groupBy("event_type").count()
    with pytest.raises(AnalysisException):
        write_stream(stream, tmp + "/out", tmp + "/ck")


def test_read_topic_stream_without_connector(spark):
    from snapkeep.sources.topic import read_topic_stream

    with pytest.raises(RuntimeError, match="Kafka source is not installed"):
        read_topic_stream(spark, topic_options("localhost:1", topic="t", security_protocol=None))


def test_partitioned_stream_sink_lower_cases_partition_names(spark, tmp):
    import os

    schema = spark.read.parquet(EVENTS).schema
    stream = read_stream_files(spark, EVENTS_GLOB, schema).withColumn("EVENT_DATE", F.col("ts").cast("date"))
    write_stream(stream, tmp + "/out", tmp + "/ck", partition_by=["EVENT_DATE"])
    dirs = [d for d in os.listdir(tmp + "/out") if "=" in d]
    assert dirs and all(d.startswith("event_date=") for d in dirs)
    assert spark.read.parquet(tmp + "/out").count() == spark.read.parquet(EVENTS).count()
