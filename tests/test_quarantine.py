"""Rejected messages: every message in exactly one of two sinks."""

import json

import pytest
from pyspark.sql import functions as F

from snapkeep.plans import extract_snapshot, latest_snapshot
from snapkeep.plans.quarantine import classify, quarantine
from snapkeep.schemas import ENVELOPE, struct
from snapkeep.sources import read_snapshot

SCHEMA = struct("id bigint, part string, name string")
MESSAGES = [
    ('{"id": 1, "part": "a", "name": "x"}', 5, None),
    ('{"id": 1, "part": "a", "name": "y"}', 6, None),
    ('  {"id": 2, "part": "b"}', 7, None),
    (None, 8, "tombstone"),
    ("", 9, "not_json"),
    ("{not json", 10, "not_json"),
    ('{"id": 3, "part"', 11, "not_json"),
    ('[{"id": 3}]', 12, "not_json"),
    ('"text"', 13, "not_json"),
    ('{"name": "no id"}', 14, "no_key"),
    ('{"id": "seven", "part": "a"}', 15, "no_key"),
    ('{"id": 4}', 16, None),
    ('{"id": 5, "part": "c"}', None, "no_offset"),
]


def envelope(spark, messages):
    rows = [(b"k", None if v is None else bytearray(v.encode()), "t", 0, o, None, 0) for v, o, _ in messages]
    return spark.createDataFrame(rows, ENVELOPE)


def test_reasons(spark):
    got = {(r["value"], r["offset"]): r["reason"] for r in classify(envelope(spark, MESSAGES), SCHEMA, "id").collect()}
    assert got == {(v, o): reason for v, o, reason in MESSAGES}


def test_composite_key(spark):
    got = classify(envelope(spark, MESSAGES), SCHEMA, ["ID", "part"]).where("offset = 16").first()
    assert got["reason"] == "no_key"


@pytest.mark.parametrize("how", [{}, {"method": "join"}, {"decode": "early"}, {"stable_input": True}])
def test_both_sinks_hold_every_message_once(spark, tmp, how):
    env = envelope(spark, MESSAGES)
    metrics = extract_snapshot(env, SCHEMA, "id", f"{tmp}/out", "2024-03-07", quarantine_root=f"{tmp}/bad", **how)
    assert {k: metrics[k] for k in ("tombstone", "not_json", "no_key", "no_offset")} == {
        "tombstone": 1, "not_json": 5, "no_key": 2, "no_offset": 1}
    assert metrics["input_rows"] == len(MESSAGES) and metrics["null_key_rows"] == 0
    bad = read_snapshot(spark, f"{tmp}/bad", "2024-03-07").collect()
    assert {(r["value"], r["offset"], r["reason"]) for r in bad} == {m for m in MESSAGES if m[2]}
    snap, _ = latest_snapshot(env, SCHEMA, "id", "2024-03-07")
    columns = ["offset", "key", "id", "part", "name"]
    key = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert key(read_snapshot(spark, f"{tmp}/out", "2024-03-07")) == key(snap)


def test_rerun_replaces_the_day_also_without_rejects(spark, tmp):
    for day in ("2024-03-07", "2024-03-08"):
        extract_snapshot(envelope(spark, MESSAGES), SCHEMA, "id", f"{tmp}/out", day, quarantine_root=f"{tmp}/bad")
    good = [m for m in MESSAGES if m[2] is None]
    metrics = extract_snapshot(envelope(spark, good), SCHEMA, "id", f"{tmp}/out", "2024-03-08", quarantine_root=f"{tmp}/bad")
    assert metrics["not_json"] == 0
    days = {str(r[0]): r[1] for r in read_snapshot(spark, f"{tmp}/bad").groupBy("extract_date").agg(F.count("*")).collect()}
    assert days == {"2024-03-07": 9}


def test_topic_is_read_once(spark, tmp):
    env = envelope(spark, MESSAGES)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    got = quarantine(env.mapInArrow(counted, ENVELOPE), SCHEMA, "id", f"{tmp}/bad", "2024-03-07")
    assert got.accepted.count() == 4 and reads.value == len(MESSAGES)
    got.remove()


def test_long_values_stay_whole(spark, tmp):
    long = json.dumps({"name": "x" * 200_000})
    quarantine(envelope(spark, [(long, 1, "no_key")]), SCHEMA, "id", f"{tmp}/bad", "2024-03-07").remove()
    assert read_snapshot(spark, f"{tmp}/bad", "2024-03-07").first()["value"] == long
