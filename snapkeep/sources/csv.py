"""CSV scans with a header line."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import col


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    strict_header: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read header CSV, with a fixed schema or inferred types.

    A schema binds columns **by position**: the header line is skipped, not
    matched, so a schema listing fields in another order reads the wrong
    columns (or nulls where a cast fails).  ``strict_header=True`` checks
    the header names against the schema and fails the read on a mismatch.
    Without a schema the types are inferred, which reads the data one more
    time over all rows (a sample would turn values its types do not cover into
    nulls); pass a schema for large inputs.  An inferred type follows the
    data: an integer column turns to BIGINT once a value needs it.
    """
    r = spark.read.format("csv").option("header", "true")
    if schema is not None:
        r = r.schema(schema)
        if strict_header:
            r = r.option("enforceSchema", "false")
    else:
        r = r.option("inferSchema", "true")
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(path)


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """`header` (the first line) of every text file under `path`, with its `file`.

    One pass over the text: a file's first block is read by one task, in
    order, so its first line is the one of the least row number there.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    first = lines.where(F.col("block") == 0).withColumn("row", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("value", "row").alias("header"))


def read_csv_by_name(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    options: Mapping[str, str] | None = None,
    missing: str = "error",
) -> DataFrame:
    """Read header CSV, binding the schema to each file's header **by name**.

    Files may hold the columns in any order, and further columns, which are
    left out; names match case-insensitively.  A file that lacks a column of
    the schema fails the read, or has it null with ``missing="null"``.  Files
    are grouped by their header line and each group is one ordinary CSV scan,
    so types, pruning and splitting work as in `read_csv`; the headers cost
    one more pass over the text.  File names and distinct headers pass through
    the driver, as a list of paths given to a reader does.  A header may not
    span lines or repeat a name.
    """
    if missing not in ("error", "null"):
        raise ValueError(f"unknown missing {missing!r}")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    opts = {"header": "true", **dict(options or {})}
    groups = file_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header")
    parts = [_read_group(spark, r["header"], [unquote(f) for f in r["files"]], schema, opts, missing) for r in groups.collect()]
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def _read_group(
    spark: SparkSession, header: str, files: list[str], schema: T.StructType, opts: dict[str, str], missing: str
) -> DataFrame:
    """The files that share one header line, with the schema's columns."""
    sep, quote_char = opts.get("sep", opts.get("delimiter", ",")), opts.get("quote", '"') or '"'
    names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")], delimiter=sep, quotechar=quote_char), [])]
    lower = [n.lower() for n in names]
    twice = sorted({n for n in lower if lower.count(n) > 1})
    if twice:
        raise ValueError(f"the header of {files[0]} repeats {twice}")
    wanted = {f.name.lower(): f for f in schema.fields}
    absent = [f.name for n, f in wanted.items() if n not in lower]
    if absent and missing == "error":
        raise ValueError(f"{files[0]} has no column {absent}; its header holds {names}")
    own = T.StructType([T.StructField(n, wanted[n.lower()].dataType if n.lower() in wanted else T.StringType()) for n in names])
    df = spark.read.format("csv").options(**opts).schema(own).load(files)
    place = dict(zip(lower, names))
    return df.select(*[
        (col(place[f.name.lower()]) if f.name.lower() in place else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
