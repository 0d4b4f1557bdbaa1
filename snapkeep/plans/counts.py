"""Row counts of tables read from their paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.counts import row_counts

_NO_COLUMNS = T.StructType([])


def table_counts(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """``(table, n_rows)`` for each named path, in one job.

    A row count reads no column, so each table is opened with an empty read
    schema: no footer-schema discovery job per table, and the scan reads
    only row-group row counts.  CSV is read with a header line unless
    `options` says otherwise; its columns are not typed.
    """
    opts = {"header": "true", **(options or {})} if fmt == "csv" else dict(options or {})

    def frame(path: str) -> DataFrame:
        r = spark.read.format(fmt).options(**opts)
        return (r if fmt == "csv" else r.schema(_NO_COLUMNS)).load(path)

    return row_counts({name: frame(p) for name, p in paths.items()})
