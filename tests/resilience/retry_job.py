"""Run the extract twice in a session that retries tasks: once clean, once with
one task failing on its first attempt.  Prints one JSON line comparing them."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from snapkeep.catalog import EVENT_PAYLOAD, events_envelope  # noqa: E402
from snapkeep.plans.extract import extract_snapshot  # noqa: E402
from snapkeep.session import build_session, scratch_path  # noqa: E402
from snapkeep.sources.parquet import read_snapshot  # noqa: E402


@F.udf(T.BinaryType())
def fail_first_attempt(v):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return v


def main():
    spark = build_session("local[4,3]", shuffle_partitions=4)  # up to 3 attempts per task
    spark.sparkContext.setLogLevel("WARN")  # the test looks for the lost task in the log
    events = spark.read.parquet(sys.argv[1]).repartition(4)
    env = events_envelope(events)
    runs = {}
    for label, frame in (("clean", env), ("retried", env.withColumn("value", fail_first_attempt("value")))):
        out = scratch_path(spark, f"retry-{label}")
        metrics = extract_snapshot(frame, EVENT_PAYLOAD, "user_id", out, extract_date="2024-03-07")
        rows = sorted(map(tuple, read_snapshot(spark, out, "2024-03-07").drop("extract_date").collect()))
        runs[label] = (metrics, rows)
    print(json.dumps({
        "same_rows": runs["clean"][1] == runs["retried"][1],
        "n_rows": len(runs["clean"][1]),
        "same_metrics": runs["clean"][0] == runs["retried"][0],
        "metrics": runs["retried"][0],
    }))


if __name__ == "__main__":
    main()
