"""Command-line jobs: ``spark-submit -m``-style entry points over the library.

    python -m snapkeep.cli count PATH [PATH ...]
    python -m snapkeep.cli extract (--envelope PATH | --brokers B (--topic T | --assign JSON)) --schema FILE
                                   --out ROOT [--day YYYY-MM-DD] [--one-per-key] [--stable-input]
    python -m snapkeep.cli compact (--envelope PATH | --brokers B --topic T [--partitions N]) --schema FILE
                                   --root ROOT (--key FIELD | --deletes [--delete-flag FIELD]) [--buckets N]
                                   [--publish LAKE [--day YYYY-MM-DD]]
    python -m snapkeep.cli enrich --entity ROOT --day D --spec FILE --out PATH

`--schema` names a file with the record schema (DDL or JSON); all its fields
are landed.  `--spec` names a JSON file with the lookups, code columns, date
casts and output columns (see `plans.enrich_from_lake`).

`compact` merges the messages that the snapshot's ledger has not read; it
starts the topic read at the recorded offsets.  The topic's password comes
from the environment (`SNAPKEEP_TOPIC_PASSWORD`), never from an argument,
which other users of the machine could see.

The session comes from ``SparkSession.builder.getOrCreate()`` (so
``spark-submit`` settings apply); the library's SQL settings are applied
on top.  Each job prints one JSON line of metrics.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from . import schemas
from .plans.counts import table_counts
from .plans.enrichment import enrich_from_lake
from .plans.extract import extract_snapshot
from .plans.incremental import compact, publish
from .session import apply_settings
from .sinks.tables import write_table
from .sources.ledger import recorded_ends, starting_offsets
from .sources.parquet import read_parquet
from .sources.topic import read_topic, topic_options


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="snapkeep")
    sub = p.add_subparsers(dest="job", required=True)

    c = sub.add_parser("count", help="row count of Parquet tables")
    c.add_argument("paths", nargs="+")

    e = sub.add_parser("extract", help="latest record per key of a topic, as one dated partition")
    src = e.add_mutually_exclusive_group(required=True)
    src.add_argument("--envelope", help="Parquet files in the topic envelope schema")
    src.add_argument("--topic", help="topic name (needs --brokers and the Kafka source package)")
    src.add_argument("--assign", help='explicit partitions, JSON like {"topic":[0,1]} (needs --brokers)')
    e.add_argument("--brokers")
    e.add_argument("--username", default=os.environ.get("SNAPKEEP_TOPIC_USER"))
    e.add_argument("--min-partitions", type=int)
    e.add_argument("--starting-offsets", default="earliest", help='"earliest" or JSON {"topic":{"0":123}}')
    e.add_argument("--ending-offsets", default="latest", help='"latest" or JSON {"topic":{"0":456}} (exclusive)')
    e.add_argument("--strict-int", action="store_true", help="INT offset column in the output")
    e.add_argument("--fail-on-data-loss", action="store_true", help="fail when wanted offsets have expired")
    e.add_argument("--schema", required=True, help="file with the record schema, DDL or JSON")
    e.add_argument("--max-files", type=int, help="cap on the files of the day")
    e.add_argument("--key", default="id")
    e.add_argument("--out", required=True)
    e.add_argument("--day", help="extract date (default: today)")
    e.add_argument("--one-per-key", action="store_true", help="break offset ties by partition")
    e.add_argument("--method", choices=["rank", "join"], default="rank")
    e.add_argument("--stable-input", action="store_true", help="checkpoint the input before compaction")
    e.add_argument("--quarantine", help="root of a table for messages without a usable key")

    m = sub.add_parser("compact", help="merge a topic's new messages into a standing snapshot")
    src = m.add_mutually_exclusive_group(required=True)
    src.add_argument("--envelope", help="Parquet files in the topic envelope schema")
    src.add_argument("--topic", help="topic name (needs --brokers and the Kafka source package)")
    m.add_argument("--brokers")
    m.add_argument("--username", default=os.environ.get("SNAPKEEP_TOPIC_USER"))
    m.add_argument("--partitions", type=int, help="the topic's number of partitions, if it has grown")
    m.add_argument("--min-partitions", type=int)
    m.add_argument("--schema", required=True, help="file with the record schema, DDL or JSON")
    m.add_argument("--root", required=True, help="the standing snapshot")
    m.add_argument("--key", action="append", help="payload key field (repeat for a composite key)")
    m.add_argument("--deletes", action="store_true", help="key by the envelope's key; messages without a value delete")
    m.add_argument("--delete-flag", help="boolean payload field that deletes")
    m.add_argument("--buckets", type=int)
    m.add_argument("--one-per-key", action="store_true", help="break offset ties by partition")
    m.add_argument("--dense", action="store_true", help="fail on any missing offset")
    m.add_argument("--publish", help="lake that gets the live records as one dated partition")
    m.add_argument("--day", help="date of the published partition (default: today)")

    n = sub.add_parser("enrich", help="a snapshot's records with columns of other snapshots")
    n.add_argument("--entity", required=True, help="snapshot lake of the entity")
    n.add_argument("--day", required=True)
    n.add_argument("--spec", required=True, help="JSON file: lookups, codes, dates, columns")
    n.add_argument("--out", required=True)
    n.add_argument("--format", default="parquet")
    return p


def run(spark: SparkSession, argv: list[str]) -> dict:
    args = _parser().parse_args(argv)
    if args.job == "count":
        rows = table_counts(spark, {p: p for p in args.paths}).collect()  # one row per path
        return {r["table"]: r["n_rows"] for r in rows}
    if args.job == "extract":
        if args.envelope:
            envelope = read_parquet(spark, args.envelope, schema=schemas.ENVELOPE)
        else:
            if not args.brokers:
                raise SystemExit("--topic and --assign need --brokers")
            envelope = read_topic(spark, topic_options(
                args.brokers, topic=args.topic, assign=args.assign,
                username=args.username, password=os.environ.get("SNAPKEEP_TOPIC_PASSWORD"),
                starting_offsets=args.starting_offsets, ending_offsets=args.ending_offsets,
                min_partitions=args.min_partitions, fail_on_data_loss=args.fail_on_data_loss,
            ))
        return extract_snapshot(
            envelope, schemas.load_schema(args.schema), args.key, args.out, extract_date=args.day,
            keep_ties=not args.one_per_key, method=args.method, stable_input=args.stable_input,
            strict_int=args.strict_int, output_partitions=args.max_files, quarantine_root=args.quarantine,
        )
    if args.job == "compact":
        if args.envelope:
            envelope = read_parquet(spark, args.envelope, schema=schemas.ENVELOPE)
        else:
            if not args.brokers:
                raise SystemExit("--topic needs --brokers")
            start = starting_offsets(
                recorded_ends(spark, args.root), {args.topic: range(args.partitions)} if args.partitions else None
            )
            envelope = read_topic(spark, topic_options(
                args.brokers, topic=args.topic, username=args.username, password=os.environ.get("SNAPKEEP_TOPIC_PASSWORD"),
                starting_offsets=start, min_partitions=args.min_partitions,
            ))
        done = compact(
            envelope, schemas.load_schema(args.schema), args.root, key=args.key, buckets=args.buckets,
            keep_ties=not args.one_per_key, deletes=args.deletes, delete_flag=args.delete_flag, dense=args.dense,
        )
        if args.publish:
            publish(spark, args.root, args.publish, args.day, version=done["version"])
        return done
    if args.job == "enrich":
        with open(args.spec, encoding="utf-8") as f:
            spec = json.load(f)
        out = enrich_from_lake(spark, args.entity, args.day, spec.pop("lookups", []), **spec)
        write_table(out, args.out, fmt=args.format, mode="overwrite")
        return {"written": args.out}
    raise SystemExit(f"unknown job {args.job}")


def main(argv: list[str] | None = None) -> int:
    spark = SparkSession.builder.appName("snapkeep").getOrCreate()
    apply_settings(spark)
    print(json.dumps(run(spark, list(sys.argv[1:] if argv is None else argv)), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
