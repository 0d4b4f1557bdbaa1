"""Plan-level checks of the scale claims (pushdown, pruning, skew handling)."""

import contextlib

from pyspark.sql import functions as F

from snapkeep.operators.enrich import Lookup, enrich
from snapkeep.operators.latest import latest_per_key
from snapkeep.operators.profile import null_profile


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def final_plan(df):
    """Physical plan after AQE re-planning (executes the frame's own plan)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_entity(spark, n=60000):
    # A third of the rows share foreign key 0 (a hot account); the rest spread.
    return spark.range(n).select(
        F.col("id").alias("eid"),
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id")).alias("fk"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


import pytest


@pytest.mark.parametrize("hot", ["value", "null"])
def test_hot_foreign_key_is_split_by_aqe(spark, hot):
    entity = skewed_entity(spark)
    if hot == "null":  # a third of the rows have no foreign key at all
        entity = entity.withColumn("fk", F.when(F.col("fk") == 0, F.lit(None)).otherwise(F.col("fk")))
    lookup = spark.range(60000).select(F.col("id").alias("id"), (F.col("id") * 2).alias("attr"))
    with conf(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    ):
        out = enrich(entity, [Lookup(lookup, key="id", on="fk", columns=["attr"])])
        plan = final_plan(out)
        assert "SortMergeJoin(skew=true)" in plan and "LeftOuter" in plan
        assert "AQEShuffleRead skewed" in plan
        assert out.count() == 60000


def test_hot_key_latest_shuffles_one_row_per_map_task(spark):
    entity = skewed_entity(spark).repartition(16)
    out = latest_per_key(entity, "fk", "eid", method="rank")
    plan = final_plan(out)
    assert out.count() == 60000 - 60000 // 3 + 1
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_null_profile_pushes_filter_to_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = null_profile(docs, ["source"], null=["lang"], not_null=["source"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(lang), IsNotNull(source)]" in plan
    assert "ReadSchema: struct<lang:string,source:string>" in plan


def test_unique_lookup_check_reuses_the_join_shuffle(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        out = enrich(orders, [Lookup(cust, key="c_custkey", on="o_custkey", columns=["c_name"], unique=True)])
        plan = out._jdf.queryExecution().executedPlan().toString()
        # one shuffle per side: the key check's grouping partitions the lookup for the join
        assert plan.count("Exchange hashpartitioning") == 2
        assert out.count() == orders.count()


def test_counts_skip_schema_discovery(spark):
    from snapkeep.plans.counts import table_counts

    out = table_counts(spark, {"orders": "/root/testdata/sf0.001/orders.parquet"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert out.first()["n_rows"] == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()


def test_bucketed_enrichment_joins_without_an_exchange(spark):
    from snapkeep import catalog

    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # the 25 nations only
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = catalog.q_enrich_bucketed(spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1


def test_capped_extract_keeps_the_compaction_tasks(spark, tmp):
    from snapkeep.operators.layout import shape_output
    from snapkeep.plans import latest_snapshot
    from snapkeep import catalog

    env = catalog.events_envelope(catalog.table(spark, "/root/testdata/sf0.01", "events"))
    snap, _ = latest_snapshot(env, catalog.EVENT_PAYLOAD, "user_id", "2024-03-07")
    plan = shape_output(snap, 2, "repartition")._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan
    # the cap's exchange stands above the window and the full decode
    assert plan.index("Exchange RoundRobinPartitioning(2)") < plan.index("Window ")


def test_topic_files_grow_in_number_not_in_size(spark, monkeypatch):
    from snapkeep import catalog

    seen = []

    def read(spark, path, schema, **kw):
        seen.append((path, kw["max_files_per_trigger"]))
        return read_stream_files(spark, path, schema, **kw)

    read_stream_files = catalog.read_stream_files
    monkeypatch.setattr(catalog, "read_stream_files", read)
    want = {tuple(r) for r in catalog.q_stream_latest_per_key(spark, "/root/testdata/sf0.01").collect()}
    monkeypatch.setattr(catalog, "TOPIC_FILE_BYTES", 1 << 16, raising=False)
    got = {tuple(r) for r in catalog.q_stream_latest_per_key(spark, "/root/testdata/sf0.01").collect()}
    assert got == want

    def sizes(path):
        return [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]

    # a small topic keeps its four files, two a micro-batch; a larger one has more, all of about one size
    (few, two), (many, half) = seen[0], seen[-1]
    assert len(sizes(few)) == 4 and two == 2
    assert len(sizes(many)) >= 20 and max(sizes(many)) < 2 * (1 << 16) / 128
    assert sum(sizes(many)) == sum(sizes(few)) and len(sizes(many)) / 2 <= half < len(sizes(many)) / 2 + 1
