import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapkeep.functions import (
    code_prefix, envelope_columns, first_code, flatten_struct, lowercase_partitions, parse_json,
    truncate_codes, with_date_from,
)

JSON_SCHEMA = "Id string, b boolean, d date, ts timestamp, s string"


def decode(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    out = flatten_struct(df.select("i", parse_json("value", JSON_SCHEMA).alias("r")), "r", keep=["i"])
    return {r["i"]: r.asDict() for r in out.collect()}


def test_bad_json_gives_all_null(spark):
    got = decode(spark, ["not json", "", None, '{"Id": "x", "s": ', '[{"Id": "x"}]'])
    for row in got.values():
        assert all(row[c] is None for c in ("Id", "b", "d", "ts", "s"))


def test_json_field_cases(spark):
    got = decode(spark, [
        '{"Id": "a", "b": "true", "s": "kept"}',
        '{"Id": "a", "s": 12}',
        '{"Id": "a", "s": {"k": 1}}',
        '{"Id": "a", "ts": 1709812800}',
        '{"Id": "a", "ts": "2024-03-07T12:00:00.000Z", "d": "2024-03-07T12:00:00"}',
        '{"id": "lower"}',
        '{"Id": "first", "Id": "last", "extra": 1}',
    ])
    assert got[0]["b"] is None and got[0]["s"] == "kept" and got[0]["Id"] == "a"
    assert got[1]["s"] == "12"
    assert got[2]["s"] == '{"k":1}'
    assert got[3]["ts"] == dt.datetime(2024, 3, 7, 12, 0)  # epoch seconds
    assert got[4]["ts"] == dt.datetime(2024, 3, 7, 12, 0) and got[4]["d"] == dt.date(2024, 3, 7)
    assert got[5]["Id"] is None
    assert got[6]["Id"] == "last"


def test_corrupt_record_capture(spark):
    df = spark.createDataFrame([("{bad",), ('{"Id": "a"}',)], "value string")
    out = df.select(parse_json("value", JSON_SCHEMA, corrupt_column="_raw").alias("r")).select("r.*")
    rows = sorted(out.collect(), key=lambda r: r["_raw"] or "")
    assert rows[0]["_raw"] is None and rows[0]["Id"] == "a"
    assert rows[1]["_raw"] == "{bad"


def test_code_prefix_and_truncate(spark):
    df = spark.createDataFrame([("ABCDEFGH", "x"), ("AB", "y"), (None, "z")], "c string, o string")
    assert [r[0] for r in df.select(code_prefix("c")).collect()] == ["ABCDE", "AB", None]
    t = truncate_codes(df, ["C"])  # case-insensitive match, replaced in place
    assert t.columns == ["c", "o"]
    assert [r["c"] for r in t.collect()] == ["ABCDE", "AB", None]


def test_first_code_fallback_is_string(spark):
    df = spark.createDataFrame(
        [(None, None, None), (None, "1234567", "x"), ("98765432", "1", None)], "a string, b string, c string"
    )
    out = df.select(first_code(["a", "b", "c"]).alias("code"))
    assert out.schema["code"].dataType == T.StringType()
    assert [r["code"] for r in out.collect()] == ["-1", "12345", "98765"]


def test_offset_casts(spark):
    df = spark.createDataFrame([(3000000000, b"k", b"v")], "offset bigint, key binary, value binary")
    wide = df.select(*envelope_columns()).first()
    assert wide["offset"] == 3000000000 and wide["key"] == "k" and wide["value"] == "v"
    narrow = df.select(*envelope_columns(strict_int=True))
    assert narrow.schema["offset"].dataType == T.IntegerType()
    with pytest.raises(Exception, match="does not fit in INT"):
        narrow.collect()
    ok = df.withColumn("offset", F.lit(7).cast("bigint")).select(*envelope_columns(strict_int=True))
    assert ok.first()["offset"] == 7


def test_date_cast_replaces_same_named_column_utc(spark):
    df = spark.createDataFrame(
        [("2024-03-07 23:30:00-05:00", dt.datetime(2000, 1, 1))], "created_at string, Created timestamp"
    ).withColumn("created_at", F.to_timestamp("created_at"))
    out = with_date_from(df, "created", "created_at")
    assert out.columns == ["created_at", "created"]
    assert out.schema["created"].dataType == T.DateType()
    assert out.first()["created"] == dt.date(2024, 3, 8)


def test_lowercase_partitions_only_partition_columns(spark):
    df = spark.createDataFrame([(1, "d", "x")], "`A.b` int, EXTRACT_DATE string, Data string")
    out, parts = lowercase_partitions(df, ["extract_date"])
    assert out.columns == ["A.b", "extract_date", "Data"]
    assert parts == ["extract_date"]
