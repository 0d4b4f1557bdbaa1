"""Physical-layout controls: output partitioning, lineage cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.naming import col


def shape_output(
    df: DataFrame,
    partitions: int | None = None,
    how: str = "rebalance",
    by: Sequence[str] = (),
) -> DataFrame:
    """Shape the partitioning of a frame before a write.

    * ``rebalance`` (default): AQE-aware shuffle (optionally by `by`) that
      targets ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` per task
      and splits skewed partitions, so files are evenly sized at any scale.
    * ``coalesce``: merge to at most `partitions` without a shuffle.  It
      also narrows the upstream stage to that many tasks, so it is only for
      small outputs.
    * ``repartition``: a full shuffle to exactly `partitions`.
    * ``none``: leave as is; a partition count is an error, not ignored.
    """
    cols = [col(c) for c in by]
    if how == "none":
        if partitions:
            raise ValueError("a partition count needs a layout")
        return df
    if how == "coalesce":
        if not partitions:
            raise ValueError("coalesce needs a partition count")
        return df.coalesce(partitions)
    if how == "repartition":
        if partitions:
            return df.repartition(partitions, *cols)
        return df.repartition(*cols)
    if how == "rebalance":
        args: list = [*cols]
        if partitions:
            args = [partitions, *cols]
        return df.hint("rebalance", *args)
    raise ValueError(f"unknown layout {how!r}")


def stable(df: DataFrame) -> DataFrame:
    """Materialise `df` into the shared checkpoint folder and cut its lineage.

    For inputs that cannot be replayed identically (a topic read with
    ``failOnDataLoss=false`` may lose expired offsets on a retry): after
    this, a lost executor recomputes from the written files, not from the
    source.  Needs ``spark.checkpoint.dir`` (see `session.ensure_checkpoint_dir`).
    """
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_stable(df: DataFrame) -> None:
    """Delete the files behind a frame that `stable` returned; it cannot be read afterwards."""
    from ..session import remove_path

    file = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        remove_path(df.sparkSession, file.get())
