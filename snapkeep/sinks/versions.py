"""Tables replaced as a whole, one committed version after another.

A versioned table is a folder holding data folders and a commit log::

    ROOT/data-<id>/...            the rows of one version (any layout)
    ROOT/versions/000000000007.json   what version 7 is: data folder, schema, layout, further facts

A write goes to a fresh data folder beside the current one; only when all its
files are there is the log entry put in place, by one rename that fails when
the entry exists.  So a write that fails part-way leaves the old version
readable, readers never see half a version, a frame may be written over the
table it reads, and of two writers that started from one version the second
fails with `VersionConflict` instead of hiding the first one's rows.

The rename is atomic on HDFS and POSIX file systems.  An object store needs a
file-system client whose rename without overwriting is (or a lock around the
job).  The log holds one small file a version; readers list that folder only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.observation import Observation

from ..session import remove_path
from .buckets import Buckets, read_bucketed, write_bucketed

LOG = "versions"


class VersionConflict(RuntimeError):
    """Another writer committed the version that this one wanted."""


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _log_file(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{LOG}/{number:012d}.json"


def version_numbers(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, ascending; none for a folder that is not there."""
    p, fs = _path(spark, f"{root.rstrip('/')}/{LOG}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_version(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The log entry of a version (default: the last); None if there is none."""
    numbers = version_numbers(spark, root)
    if number is None:
        number = numbers[-1] if numbers else None
    if number is None or number not in numbers:
        return None
    p, fs = _path(spark, _log_file(root, number))
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit_version(spark: SparkSession, root: str, number: int, entry: Mapping) -> int:
    """Put version `number` into the log; fails if it is there already."""
    sc = spark.sparkContext
    target, fs = _path(spark, _log_file(root, number))
    draft, _ = _path(spark, f"{root.rstrip('/')}/{LOG}/.draft-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({**entry, "version": number}).encode()))
    out.close()
    rename = sc._jvm.org.apache.hadoop.fs.Options.Rename
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration())
    try:
        files.rename(draft, target, how)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e) or fs.exists(target):
            raise VersionConflict(f"version {number} of {root} was committed by another writer") from e
        raise
    return number


def write_version(
    df: DataFrame,
    root: str,
    fmt: str = "parquet",
    expected: int | None = None,
    options: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    buckets: Buckets | None = None,
    dealt: bool = False,
    facts: Mapping | None = None,
    keep: int = 2,
) -> dict:
    """Replace the table by `df` and return the new log entry.

    `expected` is the version that `df` was made from (default: the last when
    the write starts); the commit fails if there is a newer one by then.
    `buckets` writes the rows bucketed and sorted (`dealt`: see
    `buckets.write_bucketed`); `facts` are further values of the entry; folders
    of earlier versions that this one still needs stand under `layers`.  Versions before the last `keep` are
    removed after the commit, so readers of older frames need `keep` set
    accordingly.
    """
    spark = df.sparkSession
    last = version_numbers(spark, root)
    expected = (last[-1] if last else 0) if expected is None else expected
    data = f"data-{uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/{data}"
    try:
        if buckets is not None:
            write_bucketed(df, path, buckets, fmt=fmt, options=options, dealt=dealt)
            n_rows = read_bucketed(spark, path, df.schema, buckets, fmt=fmt).count()  # from the files' row counts
        else:
            counted = Observation(f"version-{uuid.uuid4().hex[:8]}")
            w = df.observe(counted, F.count(F.lit(1)).alias("n_rows")).write.format(fmt).options(**dict(options or {}))
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.save(path)
            n_rows = counted.get["n_rows"]
        entry = {
            **dict(facts or {}), "data": data, "format": fmt, "options": dict(options or {}), "schema": df.schema.jsonValue(),
            "buckets": buckets.to_dict() if buckets else None, "n_rows": n_rows,
        }
        number = commit_version(spark, root, expected + 1, entry)
    except BaseException:
        remove_path(spark, path)  # nothing refers to it
        raise
    drop_old_versions(spark, root, keep)
    return {**entry, "version": number}


def read_current(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The rows of a version (default: the last), bucketed if it was written so."""
    entry = read_version(spark, root, number)
    if entry is None:
        raise FileNotFoundError(f"{root} has no {'committed version' if number is None else f'version {number}'}")
    return read_folder(spark, root, entry, entry["data"])


def read_folder(spark: SparkSession, root: str, entry: Mapping, data: str, bucketed: bool = True) -> DataFrame:
    """The rows of one data folder that a log entry refers to; `bucketed=False`
    reads a bucketed folder as plain files."""
    path = f"{root.rstrip('/')}/{data}"
    schema = T.StructType.fromJson(entry["schema"])
    if entry["buckets"] and bucketed:
        return read_bucketed(spark, path, schema, Buckets(**entry["buckets"]), fmt=entry["format"])
    return spark.read.format(entry["format"]).options(**entry["options"]).schema(schema).load(path)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove the data of versions before the last `keep`; their log entries
    stay as the table's history.  Folders that a kept version names in its
    `layers` stay too.  Returns how many were removed."""
    numbers = version_numbers(spark, root)
    kept, old = (numbers[-keep:], numbers[:-keep]) if keep else ([], numbers)
    used = {folder for n in kept for folder in read_version(spark, root, n).get("layers") or []}
    gone = 0
    # newest first; once an unused folder is gone, all before it went earlier
    for n in reversed(old):
        data = read_version(spark, root, n)["data"]
        if data in used:
            continue
        p, fs = _path(spark, f"{root.rstrip('/')}/{data}")
        if not fs.exists(p):
            break
        fs.delete(p, True)
        gone += 1
    return gone
