"""Latest record per key, kept up to date by a stream.

Each micro-batch is merged into a versioned, bucketed snapshot (see
`plans.incremental`): the batch's latest rows are dealt to the snapshot's
buckets and ranked with the standing ones.  The version that holds a batch's
rows records its number, and a batch that runs again after a failure is
recognised by it, so every message counts once although `foreachBatch` may run
a batch twice.  Between batches the snapshot is an ordinary table for readers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.incremental import apply_batch


def write_stream_latest(
    envelope: DataFrame,
    schema: T.StructType | str,
    root: str,
    checkpoint: str,
    key: str | Sequence[str] | None = None,
    stream: str = "messages",
    buckets: int | None = None,
    keep_ties: bool = True,
    deletes: bool = False,
    delete_flag: str | None = None,
    trigger: Mapping[str, object] | None = None,
    wait: bool = True,
    timeout: float | None = None,
) -> StreamingQuery:
    """Merge a streaming envelope frame into the snapshot at `root`.

    `stream` names this query in the snapshot's log; keep it with the
    checkpoint: batch numbers start anew with a new checkpoint, so that needs
    a new name.  One query writes to a snapshot at a time (a second one fails
    with `VersionConflict`).  `trigger`, `wait` and `timeout` as in
    `write_stream`; a batch rewrites the snapshot, so give it much to do.
    """

    def merge(batch: DataFrame, number: int) -> None:
        apply_batch(batch, number, stream, schema, root, key=key, buckets=buckets, keep_ties=keep_ties, deletes=deletes,
                    delete_flag=delete_flag)

    q = (
        envelope.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(**dict(trigger or {"availableNow": True})).start()
    )
    if wait:
        ended = q.awaitTermination(timeout)
        if (exc := q.exception()) is not None:
            raise exc
        if timeout is not None and not ended:
            raise TimeoutError(f"the stream to {root} is still running after {timeout} s")
    return q
