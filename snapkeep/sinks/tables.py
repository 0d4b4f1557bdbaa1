"""Batch writes: any format, optional partitioning, overwrite per partition."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.naming import lowercase_partitions
from ..operators.layout import shape_output


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    overwrite: str = "dynamic",
    partitions: int | None = None,
    layout: str | None = None,
) -> None:
    """Write `df` to `path` (parquet, csv, json, orc, ...).

    Partition columns are renamed to lower case (Hive maps partition
    directories by lower-case names); data columns keep their names.

    A partitioned ``overwrite`` replaces only the partitions present in
    `df` (``overwrite="dynamic"``), so rerunning one day leaves every other
    day untouched, and a failed rerun changes nothing (partitions are
    swapped in at job commit); ``overwrite="static"`` clears the whole path
    when the write starts, so a static overwrite that fails part-way can
    lose every day.  The same holds for rewriting a table from itself:
    dynamic mode reads everything before the commit swaps partitions in,
    while static mode deletes the files it is about to read (the job fails
    and the data is gone), so never overwrite statically a path the frame
    reads.
    An unpartitioned ``overwrite`` is staged: the rows are written beside the
    table and take its place by a rename once all of them are there, so a
    failed rerun leaves the old rows, and a table may be rewritten from itself.
    Between the two renames the path is missing for a moment; readers that
    cannot bear that, or object stores without a rename, use a versioned table
    (`versions.write_version`).  ``overwrite="static"`` writes in place, as
    above.  Task output is committed atomically, so a lost executor's retried
    task leaves no partial files.

    `layout`/`partitions` shape the write tasks (see
    `operators.layout.shape_output`).  Partitioned writes default to a
    ``rebalance`` by the partition columns: evenly sized files, and a day
    that holds most of the rows is split over several tasks, for one more
    shuffle (pass ``"none"`` when the frame is already clustered).  Other
    writes keep the frame's partitioning (``"none"``).  `partitions` without
    a layout caps the write at that many tasks, so at most that many files
    for each partition value (``"coalesce"``).
    """
    if overwrite not in ("dynamic", "static"):
        raise ValueError(f"unknown overwrite {overwrite!r}")
    opts = dict(options or {})
    parts: list[str] = []
    if partition_by:
        df, parts = lowercase_partitions(df, partition_by)
        if mode == "overwrite":
            opts.setdefault("partitionOverwriteMode", overwrite)
    if layout is None:
        layout = "coalesce" if partitions else "rebalance" if parts else "none"
    df = shape_output(df, partitions, layout, by=parts if layout == "rebalance" else ())
    staged = mode == "overwrite" and not parts and overwrite != "static"
    w = df.write.format(fmt).mode("errorifexists" if staged else mode)
    if parts:
        w = w.partitionBy(*parts)
    if opts:
        w = w.options(**opts)
    if staged:
        _replace(df.sparkSession, path, w.save)
    else:
        w.save(path)


def _replace(spark: SparkSession, path: str, save) -> None:
    """`save` to a hidden folder beside `path`, then put it in the path's place."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex[:12]
    beside = [sc._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{n}-{mark}") for n in ("new", "old")]
    new, old = beside
    try:
        save(new.toString())
        had = fs.exists(target)
        if had and not fs.rename(target, old):
            raise OSError(f"{path} could not be moved aside")
        if not fs.rename(new, target):
            if had:
                fs.rename(old, target)
            raise OSError(f"the new rows could not be moved to {path}")
        if had:
            fs.delete(old, True)
        spark.catalog.refreshByPath(path)
    finally:
        fs.delete(new, True)  # there only after a failure


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", **kw) -> None:
    write_table(df, path, fmt="parquet", mode=mode, **kw)
