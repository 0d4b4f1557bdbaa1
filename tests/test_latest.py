import random

import pytest
from pyspark.sql import functions as F

from snapkeep.operators.latest import latest_per_key, max_per_key, observe_dropped

SCHEMA = "key string, offset bigint, partition int, v string"
ROWS = [
    ("a", 1, 0, "old"), ("a", 5, 0, "new"),
    ("b", 2, 0, "p0"), ("b", 2, 1, "p1"),
    (None, 9, 0, "nul"),
    ("c", 3, 0, "only"),
    ("onlynull", None, 0, "x"),
]


def pairs(df):
    return sorted((r["key"], r["v"]) for r in df.collect())


def test_ties_kept_and_nulls_dropped(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for method in ("rank", "join"):
        out = latest_per_key(df, "key", "offset", method=method)
        assert pairs(out) == [("a", "new"), ("b", "p0"), ("b", "p1"), ("c", "only")]


def test_ties_off_breaks_by_partition(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = latest_per_key(df, "key", "offset", keep_ties=False, tiebreak="partition")
    assert pairs(out) == [("a", "new"), ("b", "p1"), ("c", "only")]


def test_ties_off_default_tiebreak_is_deterministic(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = latest_per_key(df, "key", "offset", keep_ties=False)
    # other columns break the tie, highest first: partition 1 wins
    assert pairs(out) == [("a", "new"), ("b", "p1"), ("c", "only")]


def test_join_form_rejects_ties_off(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    with pytest.raises(ValueError):
        latest_per_key(df, "key", "offset", keep_ties=False, method="join")


def test_rank_equals_join_on_random_frames(spark):
    rnd = random.Random(7)
    for trial in range(3):
        rows = []
        for i in range(300):
            k = rnd.choice([None, "k1", "k2", "k3", "hot", "hot", "hot"])
            o = rnd.choice([None, *range(6)])
            rows.append((k, o, rnd.randint(0, 2), f"v{i}"))
        df = spark.createDataFrame(rows, SCHEMA)
        a = sorted(map(tuple, latest_per_key(df, "key", "offset").collect()))
        b = sorted(map(tuple, latest_per_key(df, "key", "offset", method="join").collect()))
        assert a == b
        # row count >= distinct non-null keys with a non-null offset
        n_keys = len({r[0] for r in rows if r[0] is not None and r[1] is not None})
        assert len(a) >= n_keys


def test_idempotent(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    once = latest_per_key(df, "key", "offset")
    twice = latest_per_key(once, "key", "offset")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_composite_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 2, 1, "z")], "k1 string, k2 int, o int, v string"
    )
    out = latest_per_key(df, ["k1", "k2"], "o")
    assert sorted(r["v"] for r in out.collect()) == ["y", "z"]


def test_max_per_key(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r["key"]: r["offset"] for r in max_per_key(df, "key", "offset").collect()}
    assert got == {"a": 5, "b": 2, None: 9, "c": 3, "onlynull": None}


def test_observed_drop_counts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    observed, obs = observe_dropped(df, "key", "offset")
    latest_per_key(observed, "key", "offset").write.format("noop").mode("overwrite").save()
    assert obs.get == {"input_rows": 7, "null_key_rows": 1, "null_order_rows": 1}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_plan_one_scan_one_shuffle_with_partial_limit(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = _plan(latest_per_key(ev, "user_id", "event_id", method="rank"))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_dotted_names(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "`k.id` string, `o.n` int, v string")
    out = latest_per_key(df, "k.id", "o.n")
    assert [r["v"] for r in out.collect()] == ["y"]


def test_rows_tied_on_one_key_spread_over_tasks(spark):
    # sizes scaled down with the data: a skewed partition is one of 64 KB here
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        n = 200_000
        df = spark.range(n).repartition(8).selectExpr("if(id < 100, concat('k', id), 'hot') AS key", "id div 1000000 AS offset", "id AS v")
        out = latest_per_key(df, "key", "offset").withColumn("p", F.spark_partition_id())
        rows = [r["p"] for r in out.collect()]  # all columns, or pruning leaves nothing to split
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == n
    largest = max(rows.count(p) for p in set(rows))
    assert len(set(rows)) >= 4 and largest <= n // 2


def test_aggregate_form_equals_the_window(spark):
    import random

    rnd = random.Random(5)
    pick = lambda *xs: rnd.choice(xs)
    rows = [(pick(None, 1, 2, 3, 4), pick(None, 1, 5, 5), pick(None, "a", "b"), pick(None, 0.5, float("nan"), -1.0), i % 7)
            for i in range(300)]
    df = spark.createDataFrame(rows, "k int, o int, t string, d double, n int").repartition(5)
    for tiebreak in (None, ["d", "t", "n"]):
        how = dict(key="k", order="o", keep_ties=False, tiebreak=tiebreak)
        window = latest_per_key(df, method="rank", **how)
        grouped = latest_per_key(df, method="aggregate", **how)
        assert sorted(map(str, grouped.collect())) == sorted(map(str, window.collect()))
        assert grouped.columns == df.columns
    two = latest_per_key(df, ["k", "t"], ["o", "d"], keep_ties=False, method="aggregate")
    assert sorted(map(str, two.collect())) == sorted(map(str, latest_per_key(df, ["k", "t"], ["o", "d"], keep_ties=False, method="rank").collect()))


def test_aggregate_form_has_no_window_and_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = latest_per_key(df, "k", "o", keep_ties=False, method="aggregate")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1
    assert "partial_max_by" in plan[plan.index("Exchange"):]
    with pytest.raises(ValueError, match="one row per key"):
        latest_per_key(df, "k", "o", method="aggregate")
