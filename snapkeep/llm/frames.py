"""Small DataFrame helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapkeep.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base_docs(docs: DataFrame, *extra: str) -> DataFrame:
    """`doc_id` as long, `text` as string and the named extra columns only.

    Columns an operator does not use are dropped here, so a caller's columns
    can never clash with the ones an operator adds.
    """
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").alias("text"),
        *[docs[c] for c in extra],
    )


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back.

    Cuts the lineage: later stages and retries read the written files, which
    every executor sees, instead of running the plan again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, to size buckets by (one narrow aggregate)."""
    row = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()
    return int(row["n"] or 0)


def bucket_count(total_bytes: int, per_bucket: int, least: int = 8) -> int:
    """Buckets such that each holds about `per_bucket` bytes at any size."""
    return max(least, -(-total_bytes // per_bucket))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (once per application).

    Python functions of a plan are imported by name on the executors; where
    the package is not installed there, Spark distributes it from the driver.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), os.path.basename(top) + ".zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
