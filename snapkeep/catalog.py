"""Registered queries over the test tables, each with an equivalent SQL text.

The test tables hold no change records, so they stand in: ``events`` plays
the topic (payload key ``user_id``, offset ``event_id``), ``orders`` /
``customer`` / ``nation`` play the entity and its lookups, ``documents`` /
``labels`` a lookup with misses.  Every query reads whole tables; queries
with a write step write to a fresh folder under the shared checkpoint
folder and read the result back.

`QUERIES` maps a name to ``callable(spark, sf_dir) -> DataFrame``; `SQL`
maps the same name to the equivalent SQL text over the same tables.
Column names are the same on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.casts import envelope_columns, with_date_from
from .functions.codes import first_code, truncate_codes
from .functions.json import flatten_struct, parse_json
from .operators.enrich import Lookup, enrich
from .operators.latest import latest_per_key, max_per_key
from .operators.profile import null_profile
from .plans.counts import table_counts
from .plans.enrichment import enrich_entity
from .plans.extract import decode_envelope, extract_snapshot
from .plans.incremental import compact, live_snapshot, read_live, sized_buckets
from .schemas import ENVELOPE
from .session import scratch_path
from .sinks.buckets import Buckets
from .sinks.tables import write_table
from .sinks.versions import read_current, write_version
from .sources.csv import read_csv, read_csv_by_name
from .sources.footers import footer_counts, footer_stats
from .sources.inventory import partition_inventory
from .sources.ledger import read_ledger
from .sources.parquet import read_parquet, read_parquets, read_snapshot
from .sources.topic import slice_offsets
from .streaming.latest import write_stream_latest
from .streaming.sink import read_stream_files, write_stream

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

EXTRACT_DAY = "2024-03-07"
EVENT_PAYLOAD = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
TOPIC_PARTITIONS = 4

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# Envelope stand-in: events as messages of a topic.


def events_envelope(events: DataFrame, value: str = "record", with_edge_messages: bool = True) -> DataFrame:
    """Events as topic messages in the connector's envelope schema.

    key = user id, offset = event id (increasing within every partition),
    partition = hash of the key (as a producer's default partitioner does).
    ``value="record"`` carries the whole event as JSON, ``value="props"``
    its props text.  Two edge messages ride along in their own partition:
    a tombstone (null value) and a message that is not JSON.
    """
    if value == "record":
        payload = F.to_json(
            F.struct(*[F.col(c) for c in events.columns]),
            {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
        )
    else:
        payload = F.col(value)
    key = F.col("user_id").cast("string")
    env = events.select(
        key.cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod(F.xxhash64(key), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    if not with_edge_messages:
        return env
    # Built with JVM expressions (no Python rows): tombstone at offset 0,
    # junk at offset 1, in one partition of their own.
    rid = F.col("id")
    edge = events.sparkSession.range(0, 2, 1, 1).select(
        F.when(rid == 0, F.lit("8")).otherwise(F.lit("9")).cast("binary").alias("key"),
        F.when(rid == 1, F.lit("{not json")).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.lit(TOPIC_PARTITIONS).alias("partition"),
        rid.alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return env.unionByName(edge)


# --------------------------------------------------------------------------
# Queries.


def q_scan_with_schema(spark, d):
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("not_there", T.StringType()),
    ])
    return read_parquet(spark, f"{d}/orders.parquet", schema=schema)


def q_scan_multi_path(spark, d):
    return read_parquets(spark, [f"{d}/orders.parquet", f"{d}/orders.parquet"])


def _part_csv(spark, d) -> str:
    out = scratch_path(spark, "part-csv")
    write_table(table(spark, d, "part"), out, fmt="csv", mode="overwrite", options={"header": "true"})
    return out


def q_csv_infer(spark, d):
    return read_csv(spark, _part_csv(spark, d))


def q_csv_with_schema(spark, d):
    return read_csv(spark, _part_csv(spark, d), schema=table(spark, d, "part").schema)


def q_envelope_casts(spark, d):
    env = events_envelope(table(spark, d, "events"), value="props", with_edge_messages=False)
    return env.select(*envelope_columns())


def q_json_flatten(spark, d):
    ev = table(spark, d, "events")
    parsed = ev.select("event_id", "ts", parse_json("props", "k bigint, missing string").alias("v"))
    return flatten_struct(parsed, "v", keep=["event_id", "ts"])


def q_code_prefix(spark, d):
    return truncate_codes(table(spark, d, "part"), ["p_brand", "p_type"])


def q_to_date_cast(spark, d):
    return with_date_from(table(spark, d, "orders"), "o_orderdate", "o_orderdate")


ENRICH_COLUMNS = [
    "o_orderkey", "o_custkey", "c_name", "c_nationkey", "n_name", "o_orderstatus", "o_totalprice",
    "o_orderpriority", "o_orderdate", "c_mktsegment",
]


def q_enrich_chain(spark, d):
    return enrich_entity(
        table(spark, d, "orders"),
        [
            Lookup(table(spark, d, "customer"), key="c_custkey", on="o_custkey",
                   columns=["c_name", "c_nationkey", "c_mktsegment"]),
            Lookup(table(spark, d, "nation"), key="n_nationkey", on="c_nationkey", columns=["n_name"]),
        ],
        codes=["o_orderpriority"],
        dates={"o_orderdate": "o_orderdate"},
        columns=ENRICH_COLUMNS,
    )


def q_enrich_unique(spark, d):
    # Customer keys are unique: the in-plan check passes and the join reuses its shuffle.
    return enrich(
        table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
        [Lookup(table(spark, d, "customer"), key="c_custkey", on="o_custkey",
                columns=["c_name", "c_acctbal"], unique=True)],
    )


def _docs_labelled(spark, d) -> DataFrame:
    return enrich(
        table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"),
        [Lookup(table(spark, d, "labels"), key="doc_id", on="doc_id", columns=["quality", "toxic"])],
    )


def q_enrich_unmatched(spark, d):
    return _docs_labelled(spark, d)


def q_max_per_key(spark, d):
    return max_per_key(table(spark, d, "events"), "event_type", "event_id")


def q_latest_per_key(spark, d):
    # ids are unique, so nothing ties: the rank form scans and shuffles once
    return latest_per_key(table(spark, d, "events"), "user_id", "event_id", method="rank")


def q_latest_per_key_join(spark, d):
    return latest_per_key(table(spark, d, "events"), "user_id", "event_id", method="join")


def q_latest_per_key_ties(spark, d):
    return latest_per_key(table(spark, d, "events"), "event_type", "user_id")


def q_latest_per_key_ties_join(spark, d):
    return latest_per_key(table(spark, d, "events"), "event_type", "user_id", method="join")


def q_latest_per_key_one(spark, d):
    return latest_per_key(
        table(spark, d, "events"), "event_type", "user_id", keep_ties=False, tiebreak="event_id"
    )


def q_latest_per_key_composite(spark, d):
    return latest_per_key(table(spark, d, "events"), ["user_id", "event_type"], "event_id")


def q_row_counts(spark, d):
    return table_counts(spark, {t: f"{d}/{t}.parquet" for t in TABLES})


def _events_by_day(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.withColumn("EVENT_DATE", F.col("ts").cast("date"))


def q_partitioned_roundtrip(spark, d):
    out = scratch_path(spark, "events-by-day")
    # Rebalance by day: files of about the advisory size, a big day split
    # over several tasks (a fixed coalesce would narrow the whole upstream
    # stage to that many tasks).
    write_table(
        _events_by_day(spark, d), out, mode="overwrite", partition_by=["EVENT_DATE"], layout="rebalance"
    )
    return spark.read.parquet(out)


def q_parquet_roundtrip(spark, d):
    out = scratch_path(spark, "part-parquet")
    write_table(table(spark, d, "part"), out, mode="overwrite")
    return read_parquet(spark, out)


def q_format_roundtrip(spark, d):
    part = table(spark, d, "part")
    out = scratch_path(spark, "part-json")
    write_table(part, out, fmt="json", mode="overwrite", options={"compression": "gzip"})
    return spark.read.schema(part.schema).json(out)


def q_partitioned_format_roundtrip(spark, d):
    part = table(spark, d, "part")
    out = scratch_path(spark, "part-json-by-brand")
    write_table(
        part.withColumnRenamed("p_brand", "P_BRAND"), out, fmt="json", mode="overwrite",
        partition_by=["P_BRAND"], layout="rebalance",
    )
    return spark.read.schema(part.schema).json(out)


def q_partition_inventory(spark, d):
    out = scratch_path(spark, "events-inventory")
    # dealt by day: one file for each day, so that the SQL can state the count
    write_table(
        _events_by_day(spark, d).repartition("EVENT_DATE"), out, mode="overwrite",
        partition_by=["EVENT_DATE"], layout="none",
    )
    return partition_inventory(spark.read.parquet(out), ["event_date"])


def q_capped_write(spark, d):
    out = scratch_path(spark, "events-capped")
    write_table(
        _events_by_day(spark, d).repartition(8), out, mode="overwrite", partition_by=["EVENT_DATE"], partitions=2
    )
    found = partition_inventory(spark.read.parquet(out), ["event_date"])
    return found.select("event_date", "n_rows", (F.col("n_files") <= 2).alias("capped"))


OFFSET_SLICE = {0: (1000, 5000), 1: (None, 3000), 2: (2000, None)}


def q_topic_offset_slice(spark, d):
    env = events_envelope(table(spark, d, "events"), with_edge_messages=False)
    env = env.withColumn("partition", F.pmod("offset", F.lit(TOPIC_PARTITIONS)).cast("int"))
    return slice_offsets(env, OFFSET_SLICE).select("partition", "offset", F.col("key").cast("string").alias("key"))


# An entity with five code columns, two lookups, a date replacing a
# same-named column and an ordered projection.
FULL_CODES = ["o_orderstatus", "o_orderpriority", "o_clerk_code", "o_day_code", "o_price_code"]
FULL_COLUMNS = [
    "o_orderkey", "c_name", "c_mktsegment", "n_name", "o_orderdate", "o_totalprice", *FULL_CODES,
]


def q_enrich_full(spark, d):
    orders = table(spark, d, "orders").select(
        "*", F.col("o_custkey").cast("string").alias("o_clerk_code"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day_code"),
        F.concat(F.lit("price-"), F.col("o_orderkey").cast("string")).alias("o_price_code"),
    )
    return enrich_entity(
        orders,
        [
            Lookup(table(spark, d, "customer"), key="c_custkey", on="o_custkey",
                   columns=["c_name", "c_nationkey", "c_mktsegment"]),
            Lookup(table(spark, d, "nation"), key="n_nationkey", on="c_nationkey", columns=["n_name"]),
        ],
        codes=FULL_CODES, dates={"o_orderdate": "o_orderdate"}, columns=FULL_COLUMNS,
    )


def _extract(spark, d, **kw):
    out = scratch_path(spark, "events-snapshot")
    env = events_envelope(table(spark, d, "events"))
    extract_snapshot(env, T.StructType.fromDDL(EVENT_PAYLOAD), "user_id", out, extract_date=EXTRACT_DAY, **kw)
    return read_snapshot(spark, out, EXTRACT_DAY)


def q_extract_snapshot(spark, d):
    return _extract(spark, d)


def q_extract_snapshot_join(spark, d):
    return _extract(spark, d, method="join")


def q_extract_snapshot_early(spark, d):
    return _extract(spark, d, decode="early")


def q_stream_append(spark, d):
    ev_schema = table(spark, d, "events").schema
    out = scratch_path(spark, "events-stream")
    # Bounded micro-batches: each commits on its own, so a restart resumes
    # after the last committed batch instead of redoing everything.
    stream = read_stream_files(spark, f"{d}/event*.parquet", ev_schema, max_files_per_trigger=1000)
    decoded = flatten_struct(
        stream.select("event_id", "ts", parse_json("props", "k bigint").alias("v")), "v",
        keep=["event_id", "ts"],
    )
    write_stream(decoded, f"{out}/data", f"{out}/checkpoint")
    return spark.read.schema(decoded.schema).parquet(f"{out}/data")


def q_stream_decode_envelope(spark, d):
    # Envelope files stand in for the topic; the stream decodes each
    # micro-batch exactly as the batch extract does and appends it.
    src = scratch_path(spark, "events-envelope")
    write_table(events_envelope(table(spark, d, "events")), src, mode="overwrite")
    out = scratch_path(spark, "events-decoded-stream")
    stream = read_stream_files(spark, src, ENVELOPE, max_files_per_trigger=1000)
    decoded = decode_envelope(stream, T.StructType.fromDDL(EVENT_PAYLOAD))
    write_stream(decoded, f"{out}/data", f"{out}/checkpoint")
    return spark.read.schema(decoded.schema).parquet(f"{out}/data")


def q_code_fallback(spark, d):
    return _docs_labelled(spark, d).select("doc_id", first_code(["quality", "toxic"]).alias("code"))


def q_null_profile(spark, d):
    return null_profile(_docs_labelled(spark, d), ["lang", "source"], null=["quality"], not_null=["lang"])


# --------------------------------------------------------------------------
# Standing snapshots: slices of a topic merged one after another.


def dense_envelope(events: DataFrame) -> DataFrame:
    """Events as messages with gapless offsets in every topic partition: event
    ids are dealt to the partitions in turn.  A user's messages lie in several
    partitions, so offsets of a key can tie."""
    env = events_envelope(events, with_edge_messages=False)
    env = env.withColumn("partition", F.pmod("offset", F.lit(TOPIC_PARTITIONS)).cast("int"))
    return env.withColumn("offset", F.expr(f"offset div {TOPIC_PARTITIONS}"))


SLICES = 3
DELETE_PAYLOAD = EVENT_PAYLOAD + ", gone boolean"


def _merged_slices(spark, d) -> str:
    """The events as a topic that grows: one run after each third of it."""
    root = scratch_path(spark, "events-standing")
    events = table(spark, d, "events")
    n = events.agg(F.max("event_id")).first()[0] + 1
    for i in range(1, SLICES + 1):
        # every run gets the topic as it is by then; its ledger knows what is new
        grown = dense_envelope(events.where(F.col("event_id") < n * i // SLICES))
        compact(grown, EVENT_PAYLOAD, root, key="user_id", dense=True)
    return root


def q_incremental_compaction(spark, d):
    return read_live(spark, _merged_slices(spark, d))


def q_offset_ledger(spark, d):
    return read_ledger(spark, _merged_slices(spark, d))


def _with_deletes(events: DataFrame) -> DataFrame:
    """The dense topic, a tombstone for every tenth user and a record with a
    delete flag for every tenth from five, later than all others."""
    env = dense_envelope(events)
    users = events.where(F.col("user_id") % 5 == 0).groupBy("user_id").agg(F.max("event_id").alias("last"))
    mark = F.when(F.col("user_id") % 10 == 5, F.to_json(F.struct("user_id", F.lit(True).alias("gone"))))
    return env.unionByName(users.select(
        F.col("user_id").cast("string").cast("binary").alias("key"), mark.cast("binary").alias("value"),
        F.lit("events").alias("topic"), F.lit(TOPIC_PARTITIONS).alias("partition"),
        (F.lit(1 << 40) + F.col("user_id")).alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ))


def q_latest_with_deletes(spark, d):
    root = scratch_path(spark, "events-with-deletes")
    events = table(spark, d, "events")
    n = events.agg(F.max("event_id")).first()[0] + 1
    first = dense_envelope(events.where(F.col("event_id") < n // 2))
    for env in (first, _with_deletes(events)):
        compact(env, DELETE_PAYLOAD, root, deletes=True, delete_flag="gone")
    return read_live(spark, root).drop("gone")


def q_live_snapshot(spark, d):
    env = _with_deletes(table(spark, d, "events"))
    return live_snapshot(env, DELETE_PAYLOAD, EXTRACT_DAY, delete_flag="gone", date_col="extract_date").drop("gone")


#: Bytes of messages behind one file of the topic, not compressed; bytes of a message beside its props.
TOPIC_FILE_BYTES = 64 << 20
MESSAGE_BYTES = 128


def q_stream_latest_per_key(spark, d):
    src = scratch_path(spark, "events-topic-files")
    events = table(spark, d, "events")
    n, size = events.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.octet_length("props"), F.lit(0)) + MESSAGE_BYTES)).first()
    # A topic partition's messages are dealt over the files, so that a task's share does not grow with the topic.
    files = max(4, -(-(size or 0) // TOPIC_FILE_BYTES))
    write_table(events_envelope(events).repartition(files, "partition", "offset"), src, mode="overwrite")
    buckets = sized_buckets(n)
    out = scratch_path(spark, "events-latest-stream")
    # half of the files a micro-batch: several merges, then one more start on the same checkpoint
    for _ in range(2):
        stream = read_stream_files(spark, src, ENVELOPE, max_files_per_trigger=-(-files // 2))
        write_stream_latest(stream, EVENT_PAYLOAD, f"{out}/snapshot", f"{out}/checkpoint", key="user_id", buckets=buckets)
    return read_live(spark, f"{out}/snapshot")


def q_latest_per_key_aggregate(spark, d):
    return latest_per_key(
        table(spark, d, "events"), "event_type", "user_id", keep_ties=False, tiebreak="event_id", method="aggregate"
    )


def q_enrich_bucketed(spark, d):
    root, orders = scratch_path(spark, "bucketed"), table(spark, d, "orders")
    n = sized_buckets(orders.count())
    write_version(orders, f"{root}/orders", buckets=Buckets("o_custkey", n))
    write_version(table(spark, d, "customer"), f"{root}/customer", buckets=Buckets("c_custkey", n))
    return enrich_entity(
        read_current(spark, f"{root}/orders"),
        [
            Lookup(read_current(spark, f"{root}/customer"), key="c_custkey", on="o_custkey",
                   columns=["c_name", "c_nationkey", "c_mktsegment"]),
            Lookup(table(spark, d, "nation"), key="n_nationkey", on="c_nationkey", columns=["n_name"]),
        ],
        codes=["o_orderpriority"],
        dates={"o_orderdate": "o_orderdate"},
        columns=ENRICH_COLUMNS,
    )


def q_staged_overwrite(spark, d):
    root = scratch_path(spark, "part-versions")
    write_version(table(spark, d, "part"), root)
    # the table replaced by a frame that reads it
    write_version(read_current(spark, root).where("p_size > 10"), root, partition_by=["p_brand"])
    return read_current(spark, root)


JUNK_EVERY = 50


def q_extract_quarantine(spark, d):
    out = scratch_path(spark, "events-quarantine")
    env = events_envelope(table(spark, d, "events"))
    junk = (F.col("offset") % JUNK_EVERY == 0) & (F.col("partition") < TOPIC_PARTITIONS)
    env = env.withColumn("value", F.when(junk, F.lit("{cut").cast("binary")).otherwise(F.col("value")))
    extract_snapshot(
        env, T.StructType.fromDDL(EVENT_PAYLOAD), "user_id", f"{out}/snapshot", extract_date=EXTRACT_DAY,
        quarantine_root=f"{out}/rejected",
    )
    rejected = read_snapshot(spark, f"{out}/rejected", EXTRACT_DAY)
    kept = read_snapshot(spark, f"{out}/snapshot", EXTRACT_DAY)
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("offset").alias("offsets")).unionByName(
        kept.agg(F.lit("latest").alias("reason"), F.count(F.lit(1)).alias("n_rows"), F.sum("offset").alias("offsets")))


def q_extract_capped(spark, d):
    out = scratch_path(spark, "events-snapshot-capped")
    env = events_envelope(table(spark, d, "events"))
    extract_snapshot(env, T.StructType.fromDDL(EVENT_PAYLOAD), "user_id", out, extract_date=EXTRACT_DAY, output_partitions=2)
    found = partition_inventory(read_snapshot(spark, out, EXTRACT_DAY), ["extract_date"])
    return found.select("extract_date", "n_rows", (F.col("n_files") <= 2).alias("capped"))


def q_csv_by_name(spark, d):
    out = scratch_path(spark, "part-csv-orders")
    part = table(spark, d, "part")
    extra = part.where("p_partkey % 2 = 1").select(*reversed(part.columns), F.lit("x, y").alias("note"))
    write_table(part.where("p_partkey % 2 = 0"), out, fmt="csv", mode="append", options={"header": "true"})
    write_table(extra, out, fmt="csv", mode="append", options={"header": "true"})
    return read_csv_by_name(spark, out, part.schema)


def q_row_counts_footers(spark, d):
    return footer_counts(spark, {t: f"{d}/{t}.parquet" for t in TABLES})


def q_partition_footers(spark, d):
    out = scratch_path(spark, "events-footers")
    write_table(_events_by_day(spark, d), out, mode="overwrite", partition_by=["EVENT_DATE"])
    return footer_stats(spark, out, ["event_date"], ["event_id"])


# --------------------------------------------------------------------------
# Equivalent SQL (DuckDB dialect subset; ANSI where possible).

_LATEST_SQL = """
SELECT e.* FROM events e
JOIN (SELECT {k}, max({o}) AS m FROM events WHERE {k} IS NOT NULL GROUP BY {k}) g
  ON e.{k} = g.{k} AND e.{o} = g.m
"""

_EXTRACT_SQL = (
    "SELECT e.event_id AS \"offset\", CAST(e.user_id AS VARCHAR) AS key, e.event_id, e.ts, e.user_id, "
    f"e.event_type, e.value, e.props, DATE '{EXTRACT_DAY}' AS extract_date "
    "FROM events e JOIN (SELECT user_id, max(event_id) AS m FROM events GROUP BY user_id) g "
    "ON e.user_id = g.user_id AND e.event_id = g.m"
)

_DOCS_LABELLED = (
    "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)

# Latest by the dense offset (event id // 4), ties kept.
_DENSE_LATEST_SQL = (
    'SELECT event_id // 4 AS "offset", CAST(user_id AS VARCHAR) AS key, event_id, ts, user_id, event_type, value, props{more} '
    "FROM (SELECT *, max(event_id // 4) OVER (PARTITION BY user_id) AS m FROM events) WHERE event_id // 4 = m{where}"
)

_ENRICH_SQL = (
    "SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey, n.n_name, o.o_orderstatus, "
    "o.o_totalprice, substring(o.o_orderpriority, 1, 5) AS o_orderpriority, "
    "CAST(o.o_orderdate AS DATE) AS o_orderdate, c.c_mktsegment "
    "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
    "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"
)

SQL: dict[str, str] = {
    "incremental_compaction": _DENSE_LATEST_SQL.format(more="", where=""),
    "offset_ledger": (
        "WITH c AS (SELECT max(event_id) + 1 AS n FROM events), "
        "s AS (SELECT event_id % 4 AS p, event_id // 4 AS o, "
        "CASE WHEN event_id < n // 3 THEN 1 WHEN event_id < 2 * n // 3 THEN 2 ELSE 3 END AS v FROM events, c) "
        "SELECT CAST(v AS BIGINT) AS version, 'events' AS topic, CAST(p AS INTEGER) AS partition, min(o) AS start_offset, "
        "max(o) + 1 AS end_offset, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_holes "
        "FROM s GROUP BY v, p"
    ),
    "latest_with_deletes": _DENSE_LATEST_SQL.format(more="", where=" AND user_id % 5 <> 0"),
    "live_snapshot": _DENSE_LATEST_SQL.format(
        more=f", DATE '{EXTRACT_DAY}' AS extract_date", where=" AND user_id % 5 <> 0"),
    "stream_latest_per_key": (
        'SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS key, event_id, ts, user_id, event_type, value, props '
        "FROM events JOIN (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id) USING (user_id, event_id)"
    ),
    "latest_per_key_aggregate": (
        "SELECT event_id, ts, user_id, event_type, value, props FROM ("
        "SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY user_id DESC, event_id DESC) AS rn "
        "FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL) t WHERE rn = 1"
    ),
    "enrich_bucketed": _ENRICH_SQL,
    "staged_overwrite": "SELECT * FROM part WHERE p_size > 10",
    "extract_quarantine": (
        "SELECT 'tombstone' AS reason, CAST(1 AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS offsets "
        "UNION ALL SELECT 'not_json', 1 + count(*), CAST(1 + sum(event_id) AS BIGINT) FROM events WHERE event_id % 50 = 0 "
        "UNION ALL SELECT 'latest', count(*), CAST(sum(m) AS BIGINT) FROM "
        "(SELECT max(event_id) AS m FROM events WHERE event_id % 50 <> 0 GROUP BY user_id)"
    ),
    "extract_capped": (
        f"SELECT DATE '{EXTRACT_DAY}' AS extract_date, count(DISTINCT user_id) AS n_rows, TRUE AS capped FROM events"
    ),
    "csv_by_name": "SELECT * FROM part",
    "row_counts_footers": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "partition_footers": (
        "SELECT CAST(ts AS DATE) AS event_date, count(*) AS n_rows, min(event_id) AS min_event_id, max(event_id) AS max_event_id "
        "FROM events GROUP BY CAST(ts AS DATE)"
    ),
    "scan_with_schema": "SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS not_there FROM orders",
    "scan_multi_path": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "csv_infer": (
        "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice "
        "FROM part"
    ),
    "csv_with_schema": "SELECT * FROM part",
    "envelope_casts": (
        'SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS key, props AS value '
        "FROM events"
    ),
    "json_flatten": (
        "SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
        "CAST(NULL AS VARCHAR) AS missing FROM events"
    ),
    "code_prefix": (
        "SELECT p_partkey, p_name, substring(p_brand, 1, 5) AS p_brand, substring(p_type, 1, 5) AS p_type, "
        "p_size, p_retailprice FROM part"
    ),
    "to_date_cast": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
        "o_orderpriority FROM orders"
    ),
    "enrich_chain": _ENRICH_SQL,
    "enrich_unmatched": f"SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM {_DOCS_LABELLED}",
    "max_per_key": "SELECT event_type, max(event_id) AS event_id FROM events GROUP BY event_type",
    "latest_per_key": _LATEST_SQL.format(k="user_id", o="event_id"),
    "latest_per_key_join": _LATEST_SQL.format(k="user_id", o="event_id"),
    "latest_per_key_ties": _LATEST_SQL.format(k="event_type", o="user_id"),
    "latest_per_key_ties_join": _LATEST_SQL.format(k="event_type", o="user_id"),
    "latest_per_key_one": (
        "SELECT event_id, ts, user_id, event_type, value, props FROM ("
        "SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY user_id DESC, event_id DESC) AS rn "
        "FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL) t WHERE rn = 1"
    ),
    "latest_per_key_composite": (
        "SELECT e.* FROM events e JOIN (SELECT user_id, event_type, max(event_id) AS m FROM events "
        "WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY user_id, event_type) g "
        "ON e.user_id = g.user_id AND e.event_type = g.event_type AND e.event_id = g.m"
    ),
    "enrich_unique": (
        "SELECT o.o_custkey, o.o_orderkey, o.o_totalprice, c.c_name, c.c_acctbal "
        "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"
    ),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "partitioned_roundtrip": "SELECT *, CAST(ts AS DATE) AS event_date FROM events",
    "parquet_roundtrip": "SELECT * FROM part",
    "format_roundtrip": "SELECT * FROM part",
    "partitioned_format_roundtrip": "SELECT * FROM part",
    "partition_inventory": (
        "SELECT CAST(ts AS DATE) AS event_date, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files "
        "FROM events GROUP BY CAST(ts AS DATE)"
    ),
    "capped_write": (
        "SELECT CAST(ts AS DATE) AS event_date, count(*) AS n_rows, TRUE AS capped FROM events GROUP BY CAST(ts AS DATE)"
    ),
    "topic_offset_slice": (
        'SELECT CAST(event_id % 4 AS INTEGER) AS partition, event_id AS "offset", CAST(user_id AS VARCHAR) AS key FROM events '
        "WHERE (event_id % 4 = 0 AND event_id >= 1000 AND event_id < 5000) OR (event_id % 4 = 1 AND event_id < 3000) "
        "OR (event_id % 4 = 2 AND event_id >= 2000)"
    ),
    "enrich_full": (
        "SELECT o.o_orderkey, c.c_name, c.c_mktsegment, n.n_name, CAST(o.o_orderdate AS DATE) AS o_orderdate, o.o_totalprice, "
        "substring(o.o_orderstatus, 1, 5) AS o_orderstatus, substring(o.o_orderpriority, 1, 5) AS o_orderpriority, "
        "substring(CAST(o.o_custkey AS VARCHAR), 1, 5) AS o_clerk_code, "
        "substring(strftime(o.o_orderdate, '%Y-%m-%d'), 1, 5) AS o_day_code, 'price' AS o_price_code "
        "FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
        "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"
    ),
    "extract_snapshot": _EXTRACT_SQL,
    "extract_snapshot_join": _EXTRACT_SQL,
    "extract_snapshot_early": _EXTRACT_SQL,
    "stream_append": (
        "SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
    ),
    "stream_decode_envelope": (
        'SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS key, event_id, ts, user_id, event_type, '
        "value, props FROM events UNION ALL "
        'SELECT CAST(o AS BIGINT) AS "offset", k AS key, CAST(NULL AS BIGINT) AS event_id, '
        "CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS VARCHAR) AS event_type, "
        "CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS props "
        "FROM (VALUES (0, '8'), (1, '9')) AS edge(o, k)"
    ),
    "code_fallback": (
        "SELECT d.doc_id, COALESCE(substring(CAST(l.quality AS VARCHAR), 1, 5), "
        "substring(CAST(l.toxic AS VARCHAR), 1, 5), '-1') AS code "
        f"FROM {_DOCS_LABELLED}"
    ),
    "null_profile": (
        f"SELECT d.lang, d.source, count(*) AS \"count\" FROM {_DOCS_LABELLED} "
        "WHERE l.quality IS NULL AND d.lang IS NOT NULL GROUP BY d.lang, d.source HAVING count(*) >= 1"
    ),
}

QUERIES: dict[str, Query] = {
    "scan_with_schema": q_scan_with_schema,
    "scan_multi_path": q_scan_multi_path,
    "csv_infer": q_csv_infer,
    "csv_with_schema": q_csv_with_schema,
    "envelope_casts": q_envelope_casts,
    "json_flatten": q_json_flatten,
    "code_prefix": q_code_prefix,
    "to_date_cast": q_to_date_cast,
    "enrich_chain": q_enrich_chain,
    "enrich_unmatched": q_enrich_unmatched,
    "enrich_unique": q_enrich_unique,
    "max_per_key": q_max_per_key,
    "latest_per_key": q_latest_per_key,
    "latest_per_key_join": q_latest_per_key_join,
    "latest_per_key_ties": q_latest_per_key_ties,
    "latest_per_key_ties_join": q_latest_per_key_ties_join,
    "latest_per_key_one": q_latest_per_key_one,
    "latest_per_key_composite": q_latest_per_key_composite,
    "row_counts": q_row_counts,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "parquet_roundtrip": q_parquet_roundtrip,
    "format_roundtrip": q_format_roundtrip,
    "partitioned_format_roundtrip": q_partitioned_format_roundtrip,
    "partition_inventory": q_partition_inventory,
    "capped_write": q_capped_write,
    "topic_offset_slice": q_topic_offset_slice,
    "enrich_full": q_enrich_full,
    "extract_snapshot": q_extract_snapshot,
    "extract_snapshot_join": q_extract_snapshot_join,
    "extract_snapshot_early": q_extract_snapshot_early,
    "stream_append": q_stream_append,
    "stream_decode_envelope": q_stream_decode_envelope,
    "code_fallback": q_code_fallback,
    "null_profile": q_null_profile,
    "latest_per_key_aggregate": q_latest_per_key_aggregate,
    "incremental_compaction": q_incremental_compaction,
    "offset_ledger": q_offset_ledger,
    "latest_with_deletes": q_latest_with_deletes,
    "live_snapshot": q_live_snapshot,
    "stream_latest_per_key": q_stream_latest_per_key,
    "extract_quarantine": q_extract_quarantine,
    "extract_capped": q_extract_capped,
    "enrich_bucketed": q_enrich_bucketed,
    "staged_overwrite": q_staged_overwrite,
    "csv_by_name": q_csv_by_name,
    "row_counts_footers": q_row_counts_footers,
    "partition_footers": q_partition_footers,
}
