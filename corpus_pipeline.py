"""A pipeline preparing a training corpus from `documents`.

Stages, each written as Parquet and read again as the next one's input:
line-first quality rules (rejected documents go, failing lines are removed),
n-gram Jaccard join (one document of each group of near duplicates stays),
benchmark decontamination (documents leaking an item go), secret scans
(secrets are replaced in the text), packing (pieces with their sequences).

All stages but the last return the columns of `documents`.  Nulls, empty
texts, repeated rows, empty tables and further columns are handled as the
operators state; `n_chars` is counted again where a text changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapkeep.llm import decontam, jaccard, packing, quality, secret_scan
from snapkeep.llm.frames import cut, read_table, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard.keep_one_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return secret_scan.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secrets),
    ("packing", pack),
]

#: SQL cannot express packing or the redaction of parsed secrets; the tests
#: compare every stage with a brute-force version on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
