import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from snapkeep.cli import run
from snapkeep.sinks.tables import write_table
from snapkeep.sources.parquet import read_snapshot

FIELDS = 95


def _envelope(spark, path):
    """Messages of a record with 95 fields, several versions of a key."""
    rows = [("i1", 1, "r1", "OLDCODE99"), ("i1", 5_000_000_000, "r1", "NEWCODE99"), ("i2", 2, "r9", None), ("i3", 3, None, "XY")]
    df = spark.createDataFrame(rows, "id string, offset bigint, region_fk string, code string")
    extra = [F.concat(F.lit(f"v{i}-"), "id").alias(f"f{i:02d}") for i in range(FIELDS - 3)]
    env = df.select(
        F.col("id").cast("binary").alias("key"),
        F.to_json(F.struct("id", "region_fk", "code", *extra)).cast("binary").alias("value"),
        F.lit("records").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.lit(None).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    env.write.mode("overwrite").parquet(path)
    return "id string, region_fk string, code string, " + ", ".join(f"f{i:02d} string" for i in range(FIELDS - 3))


def test_cli_lands_every_field_then_enriches_and_counts(spark, tmp):
    ddl = _envelope(spark, tmp + "/env")
    with open(tmp + "/schema.ddl", "w") as f:
        f.write(ddl.replace(", ", ",\n"))
    m = run(spark, ["extract", "--envelope", tmp + "/env", "--schema", tmp + "/schema.ddl",
                    "--out", tmp + "/lake/records", "--day", "2024-03-07", "--max-files", "2"])
    assert m["output_rows"] == 3 and m["null_key_rows"] == 0
    snap = read_snapshot(spark, tmp + "/lake/records", "2024-03-07")
    assert len(snap.columns) == FIELDS + 3  # offset, key and the day beside the record
    rows = {r["id"]: r for r in snap.collect()}
    assert rows["i1"]["code"] == "NEWCODE99" and rows["i1"]["offset"] == 5_000_000_000
    assert all(rows["i3"][f"f{i:02d}"] == f"v{i}-i3" for i in range(FIELDS - 3))

    region = spark.createDataFrame([("r1", "L1")], "id string, label string")
    write_table(region.withColumn("EXTRACT_DATE", F.lit(dt.date(2024, 2, 14))), tmp + "/lake/region",
                mode="overwrite", partition_by=["EXTRACT_DATE"])
    spec = {"lookups": [{"root": tmp + "/lake/region", "day": "2024-02-14", "key": "id", "on": "region_fk", "columns": ["label"]}],
            "codes": ["code"], "columns": ["id", "label", "code"]}
    with open(tmp + "/spec.json", "w") as f:
        json.dump(spec, f)
    run(spark, ["enrich", "--entity", tmp + "/lake/records", "--day", "2024-03-07", "--spec", tmp + "/spec.json",
                "--out", tmp + "/enriched"])
    out = spark.read.parquet(tmp + "/enriched")
    assert out.columns == ["id", "label", "code"]
    assert sorted(map(tuple, out.collect()), key=str) == [("i1", "L1", "NEWCO"), ("i2", None, None), ("i3", None, "XY")]
    assert run(spark, ["count", tmp + "/enriched", tmp + "/env"]) == {tmp + "/enriched": 3, tmp + "/env": 4}


def test_cli_reads_a_json_schema_and_requires_one(spark, tmp):
    from pyspark.sql import types as T

    from snapkeep.schemas import load_schema

    ddl = _envelope(spark, tmp + "/env")
    want = T.StructType.fromDDL(ddl)
    with open(tmp + "/schema.json", "w") as f:
        f.write(want.json())
    assert load_schema(tmp + "/schema.json") == want == load_schema(ddl)
    with pytest.raises(SystemExit):
        run(spark, ["extract", "--envelope", tmp + "/env", "--out", tmp + "/lake"])


def test_cli_compacts_slices_and_publishes(spark, tmp):
    ddl = _envelope(spark, tmp + "/env")
    with open(tmp + "/schema.ddl", "w") as f:
        f.write(ddl)
    args = ["compact", "--schema", tmp + "/schema.ddl", "--root", tmp + "/s", "--key", "id", "--buckets", "2"]
    spark.read.parquet(tmp + "/env").where("offset < 3").write.parquet(tmp + "/part")
    assert run(spark, [*args, "--envelope", tmp + "/part"])["version"] == 1
    done = run(spark, [*args, "--envelope", tmp + "/env", "--publish", tmp + "/lake", "--day", "2024-03-07"])
    assert done["version"] == 2 and done["input_rows"] == 2
    snap = read_snapshot(spark, tmp + "/lake", "2024-03-07")
    assert {r["id"]: r["code"] for r in snap.collect()} == {"i1": "NEWCODE99", "i2": None, "i3": "XY"}
    with pytest.raises(SystemExit):
        run(spark, ["compact", "--topic", "t", "--schema", tmp + "/schema.ddl", "--root", tmp + "/s", "--key", "id"])
    with pytest.raises(SystemExit):  # a password is no argument
        run(spark, ["extract", "--topic", "t", "--password", "x", "--schema", tmp + "/schema.ddl", "--out", tmp + "/o"])
