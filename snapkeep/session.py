"""Session settings and the shared scratch location.

The library never builds a session inside an operator: callers pass one in.
`build_session` is a convenience for scripts and tests; `apply_settings`
sets the runtime SQL options the operators rely on an existing session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators assume.
# Fixed values (as the reference job sets them): UTC session time zone
# (timestamp -> date casts depend on it), no Parquet schema merging,
# Parquet filter pushdown on, 900 s broadcast timeout.
# Added for scale: AQE re-plans joins and shuffle partition counts from
# runtime sizes and splits skewed join partitions.
SQL_SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.broadcastTimeout": "900",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"


def apply_settings(spark: SparkSession, extra: dict[str, str] | None = None) -> SparkSession:
    """Set the runtime SQL options on an existing session."""
    for k, v in {**SQL_SETTINGS, **(extra or {})}.items():
        spark.conf.set(k, v)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "snapkeep",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or get) a session with the library settings.

    On a cluster leave `master` unset and size `shuffle_partitions` to the
    input (for example input bytes / 256 MB); AQE coalesces small ones.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SQL_SETTINGS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _master(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.master
    except Exception:  # no JVM context (e.g. a remote session)
        return spark.conf.get("spark.master", "") or ""


def _is_local(spark: SparkSession) -> bool:
    return _master(spark).startswith("local")


def _conf_value(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(key)
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by `spark.checkpoint.dir`.

    The cluster setting is always preferred.  Only a local-mode session with
    no setting (tests, laptops) gets a fresh temporary folder, registered as
    the context's checkpoint folder; on a cluster an unset value is an
    error, since a machine-local folder is not shared between executors.
    """
    root = _conf_value(spark, CHECKPOINT_CONF)
    try:
        sc = spark.sparkContext
    except Exception:  # no JVM context: only the setting can name the folder
        sc = None
    if not root and sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not root:
        if not _is_local(spark) or sc is None:
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; name a shared folder (HDFS/object store) for the cluster"
            )
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="snapkeep-ckpt-"))
        return sc.getCheckpointDir()
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_root(spark: SparkSession) -> str:
    """The folder under the shared checkpoint folder that holds all scratch tables of this application."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapkeep-{_conf_value(spark, 'spark.app.id') or 'session'}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the application's scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever Spark's file systems keep it; none is fine."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch tables.

    For the session's owner, once the frames that read them were consumed:
    a frame returned earlier cannot be read again after this.
    """
    remove_path(spark, scratch_root(spark))
