import datetime as dt
import os
from urllib.parse import urlparse

from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapkeep.catalog import EVENT_PAYLOAD, events_envelope
from snapkeep.plans.extract import decode_envelope, extract_snapshot, latest_snapshot
from snapkeep.schemas import ENVELOPE
from snapkeep.session import remove_scratch, scratch_path
from snapkeep.sources.parquet import read_snapshot

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_envelope_schema(spark):
    env = events_envelope(spark.read.parquet(EVENTS))
    assert env.schema.simpleString() == ENVELOPE.simpleString()


def test_decode_keeps_offset_and_key_then_payload(spark):
    env = events_envelope(spark.read.parquet(EVENTS))
    dec = decode_envelope(env, T.StructType.fromDDL(EVENT_PAYLOAD))
    assert dec.columns[:3] == ["offset", "key", "event_id"]
    assert dec.schema["offset"].dataType == T.LongType()
    # tombstone and junk message decode to all-null payloads
    assert dec.where(F.col("user_id").isNull()).count() == 2


def test_extract_end_to_end_and_rerun(spark, tmp):
    events = spark.read.parquet(EVENTS)
    env = events_envelope(events)
    schema = T.StructType.fromDDL(EVENT_PAYLOAD)
    m1 = extract_snapshot(env, schema, "user_id", tmp + "/lake", extract_date="2024-03-07")
    n_users = events.select("user_id").distinct().count()
    assert m1 == {"input_rows": events.count() + 2, "null_key_rows": 2, "null_order_rows": 0,
                  "output_rows": n_users}
    first = read_snapshot(spark, tmp + "/lake", "2024-03-07")
    assert first.count() == n_users
    assert first.schema["extract_date"].dataType == T.DateType()
    # the payload survives the JSON round trip exactly (microsecond timestamps included)
    expect = events.join(events.groupBy("user_id").agg(F.max("event_id").alias("event_id")),
                         ["user_id", "event_id"]).select(*events.columns)
    got = first.select(*events.columns)
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0
    # rerun of the same day: same rows; another day is added next to it
    first_rows = sorted(map(tuple, first.collect()))
    extract_snapshot(env, schema, "user_id", tmp + "/lake", extract_date="2024-03-07")
    extract_snapshot(env, schema, "user_id", tmp + "/lake", extract_date="2024-03-08")
    again = read_snapshot(spark, tmp + "/lake", "2024-03-07")
    assert sorted(map(tuple, again.collect())) == first_rows
    assert read_snapshot(spark, tmp + "/lake").count() == 2 * n_users


def test_ties_across_partitions(spark):
    payload = '{"id": "a", "v": "%s"}'
    rows = [
        (b"a", (payload % "p0").encode(), "t", 0, 7, None, 0),
        (b"a", (payload % "p1").encode(), "t", 1, 7, None, 0),
        (b"a", (payload % "old").encode(), "t", 1, 3, None, 0),
    ]
    env = spark.createDataFrame(rows, ENVELOPE)
    kept, _ = latest_snapshot(env, "id string, v string", "id", extract_date="2024-03-07")
    assert sorted(r["v"] for r in kept.collect()) == ["p0", "p1"]
    one, _ = latest_snapshot(env, "id string, v string", "id", extract_date=dt.date(2024, 3, 7),
                             keep_ties=False)
    assert [r["v"] for r in one.collect()] == ["p1"]
    assert "partition" not in one.columns


def test_stable_input_uses_shared_checkpoint_folder(spark, tmp):
    env = events_envelope(spark.read.parquet(EVENTS))
    snap, _ = latest_snapshot(env, EVENT_PAYLOAD, "user_id", extract_date="2024-03-07", stable_input=True)
    plan = snap._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan  # lineage cut at the decoded records
    assert snap.count() == spark.read.parquet(EVENTS).select("user_id").distinct().count()


def test_join_form_matches_rank_form(spark, tmp):
    env = events_envelope(spark.read.parquet(EVENTS))
    m_rank = extract_snapshot(env, EVENT_PAYLOAD, "user_id", tmp + "/a", extract_date="2024-03-07")
    m_join = extract_snapshot(env, EVENT_PAYLOAD, "user_id", tmp + "/b", extract_date="2024-03-07",
                              method="join")
    assert m_rank == m_join
    a = sorted(map(tuple, read_snapshot(spark, tmp + "/a").collect()))
    b = sorted(map(tuple, read_snapshot(spark, tmp + "/b").collect()))
    assert a == b
    assert not spark.sparkContext._jsc.getPersistentRDDs()


JSON_EDGE = [
    '{"id": "a", "v": "1", "n": 1}', '{"id": "a", "v": "2", "n": "x"}',  # wrong type elsewhere
    '{"id": "b", "v": "3"', '[{"id": "b"}]', "not json", "", None,       # bad messages
    '{"ID": "c", "v": "4"}', '{"id": "c", "id": "d", "v": "5"}',          # case, repeated name
    '{"id": 12, "v": {"k": 1}}', '{"id": "e", "v": null}',
]


def test_late_decode_equals_early_decode(spark):
    rows = [(b"k", None if t is None else t.encode(), "t", i % 2, i // 2, None, 0) for i, t in enumerate(JSON_EDGE)]
    env = spark.createDataFrame(rows, ENVELOPE)
    for keep_ties in (True, False):
        for method in (("rank", "join") if keep_ties else ("rank",)):
            got = {}
            for decode in ("early", "late"):
                snap, obs = latest_snapshot(env, "id string, v string, n int", "id", "2024-03-07",
                                            keep_ties=keep_ties, method=method, decode=decode)
                got[decode] = (snap.columns, sorted(map(tuple, snap.collect())), obs)
            assert got["early"][0] == got["late"][0]
            assert got["early"][1] == got["late"][1]
            assert got["early"][2].get == got["late"][2].get
    ids = sorted(r[2] for r in got["late"][1])
    assert ids == ["12", "a", "d", "e"]


def test_empty_topic_writes_nothing_and_keeps_other_days(spark, tmp):
    env = events_envelope(spark.read.parquet(EVENTS))
    extract_snapshot(env, EVENT_PAYLOAD, "user_id", tmp + "/lake", extract_date="2024-03-06")
    before = read_snapshot(spark, tmp + "/lake").count()
    empty = spark.createDataFrame([], ENVELOPE)
    m = extract_snapshot(empty, EVENT_PAYLOAD, "user_id", tmp + "/lake", extract_date="2024-03-07")
    assert m == {"input_rows": 0, "null_key_rows": 0, "null_order_rows": 0, "output_rows": 0}
    assert read_snapshot(spark, tmp + "/lake").count() == before


def test_strict_int_fails_on_overflow(spark):
    import pytest

    payload = '{"id": "a", "v": "%s"}'

    def snap(offset, **kw):
        rows = [(b"a", (payload % "old").encode(), "t", 0, 5, None, 0),
                (b"a", (payload % "new").encode(), "t", 0, offset, None, 0)]
        return latest_snapshot(spark.createDataFrame(rows, ENVELOPE), "id string, v string", "id", "2024-03-07", **kw)[0]

    big = 5_000_000_000
    assert [(r["v"], r["offset"]) for r in snap(big).collect()] == [("new", big)]
    small = snap(7, strict_int=True)
    assert dict(small.dtypes)["offset"] == "int" and [r["offset"] for r in small.collect()] == [7]
    with pytest.raises(Exception, match="does not fit in INT"):
        snap(big, strict_int=True).collect()


def test_output_partitions_cap_the_files_of_the_day(spark, tmp):
    import glob

    env = events_envelope(spark.read.parquet(EVENTS)).repartition(8)
    extract_snapshot(env, EVENT_PAYLOAD, "user_id", tmp + "/lake", extract_date="2024-03-07", output_partitions=2)
    assert 1 <= len(glob.glob(tmp + "/lake/extract_date=2024-03-07/*.parquet")) <= 2


def test_composite_key_is_parsed_once_and_join_form_is_not_cached(spark):
    env = events_envelope(spark.read.parquet(EVENTS))
    snap, _ = latest_snapshot(env, EVENT_PAYLOAD, ["user_id", "event_type"], "2024-03-07", decode="late")
    plan = snap._jdf.queryExecution().optimizedPlan().toString()
    # one parse of the key fields, one of the surviving messages
    assert plan.count("from_json(") == 2
    join, _ = latest_snapshot(env, EVENT_PAYLOAD, "user_id", "2024-03-07", method="join")
    plan = join._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan and "LogicalRDD" in plan


def _files(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names)


def test_repeated_extracts_leave_only_the_snapshot(spark, tmp):
    env = events_envelope(spark.read.parquet(EVENTS))
    held = urlparse(spark.sparkContext.getCheckpointDir()).path
    before = _files(held)
    for form in ({"stable_input": True}, {"method": "join"}, {"stable_input": True, "decode": "early"}):
        metrics = extract_snapshot(env, EVENT_PAYLOAD, "user_id", tmp + "/lake", extract_date="2024-03-07", **form)
        assert metrics["output_rows"] == read_snapshot(spark, tmp + "/lake").count()
    assert _files(held) == before
    assert {os.path.basename(os.path.dirname(f)) for f in _files(tmp + "/lake") if f.endswith(".parquet")} == {
        "extract_date=2024-03-07"}


def test_remove_scratch_deletes_what_the_application_wrote(spark, tmp, monkeypatch):
    monkeypatch.setattr("snapkeep.session.ensure_checkpoint_dir", lambda spark: tmp)
    path = scratch_path(spark, "part")
    spark.range(5).write.parquet(path)
    assert path.startswith(tmp) and spark.read.parquet(path).count() == 5
    remove_scratch(spark)
    assert _files(tmp) == []
    remove_scratch(spark)  # nothing left to delete


def test_payload_field_clashing_with_envelope_columns(spark):
    import pytest

    env = spark.createDataFrame([], ENVELOPE)
    with pytest.raises(ValueError, match="clash"):
        latest_snapshot(env, "id string, Offset bigint", "id", "2024-03-07")


def test_snapshot_files_come_out_sorted_by_key(spark, tmp):
    import glob
    import os

    import pyarrow.parquet as pq

    env = events_envelope(spark.read.parquet(EVENTS))
    extract_snapshot(env, EVENT_PAYLOAD, "user_id", tmp + "/lake", extract_date="2024-03-07")
    files = glob.glob(os.path.join(tmp, "lake", "extract_date=2024-03-07", "*.parquet"))
    assert files
    for f in files:
        keys = pq.read_table(f, columns=["user_id"]).column(0).to_pylist()
        assert keys == sorted(keys)
