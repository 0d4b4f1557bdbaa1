"""Sharding in Hilbert-curve order.

Several metadata dimensions are quantised to a few bits each (sizes by
quantiles of the whole table, categories by a hash of their value), mapped to
their index on the Hilbert curve, and the rows sorted by that index are cut
into runs of equal length.  Neighbouring cells differ in one dimension only,
so each shard covers a compact region and its file's statistics prune on
several columns at once.

The sort is a distributed ranking: rows are numbered within (cell, salt)
groups, and the groups' row counts are summed up in two bounded steps (within
a coarse run of the curve, then over the coarse runs), so a cell holding a
third of all rows is ranked by many tasks.  Only ids, sizes and checksums are
shuffled, never texts: they are read once, and the narrow rows (then with
their curve index) are written to the shared checkpoint folder.

Law `rows`: shard counts are at most one apart.

Defined cases: a null text has size 1 and the checksum of the empty text; a
null category is a cell of its own kind (0); null doc_ids and repeated rows
are rows like others; a table of fewer rows than shards leaves shards empty;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapkeep.llm.frames import cut

SHARDS = 16
#: Bits of each dimension.
BITS = 5
#: Top bits of the curve index that name a coarse run: at most 2**10 of them.
COARSE_BITS = 10
#: Groups a cell is split into for ranking.
SALTS = 256


def with_hilbert(df: DataFrame, cells: list[Column], bits: int, name: str) -> DataFrame:
    """`df` with a column `name`: the index on the Hilbert curve of `cells`,
    each below 2**bits.

    The transposed-axes form: undo the excess rotations from the top bit down,
    Gray-encode, then interleave the bits.
    """
    dims = len(cells)
    steps = ", ".join(f"named_struct('q', {1 << b}, 'i', {i})" for b in range(bits - 1, 0, -1) for i in range(dims))
    levels = ", ".join(str(1 << b) for b in range(bits - 1, 0, -1))
    taken = ", ".join(f"named_struct('b', {b}, 'i', {i})" for b in range(bits - 1, -1, -1) for i in range(dims))
    turned = f"""
        aggregate(array({steps}), __cells, (s, e) ->
            if(s[e.i] & e.q <> 0,
               transform(s, (v, j) -> if(j = 0, v ^ (e.q - 1), v)),
               transform(s, (v, j) -> if(j = 0 or j = e.i, v ^ ((s[0] ^ s[e.i]) & (e.q - 1)), v))))"""
    gray = "transform(t, (v, j) -> aggregate(slice(t, 1, j + 1), 0, (a, y) -> a ^ y))"
    flip = f"aggregate(array({levels}), 0, (a, q) -> if(element_at(g, -1) & q <> 0, a ^ (q - 1), a))"
    index = f"aggregate(array({taken}), 0L, (a, e) -> a * 2 + (shiftright(g[e.i] ^ f, e.b) & 1))"
    # a one-element transform binds a step's result, so that it is computed once
    whole = f"transform(array({turned}), t -> transform(array({gray}), g -> transform(array({flip}), f -> {index})[0])[0])[0]"
    return df.withColumn("__cells", F.array(*[c.cast("int") for c in cells])).withColumn(name, F.expr(whole)).drop("__cells")


def quantile_cell(value: Column, edges: list) -> Column:
    """Number of `edges` (ascending) below `value`; 0 for null."""
    cell = F.lit(0)
    for e in edges:
        cell = cell + F.when(value > F.lit(e), 1).otherwise(0)
    return cell


def category_cell(value: Column, bits: int) -> Column:
    """A cell for a category: a hash of its value, 0 for null."""
    return F.coalesce(F.pmod(F.crc32(value.cast("string").cast("binary")), F.lit(1 << bits)), F.lit(0))


def curve_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, salts: int = SALTS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        docs["lang"].alias("lang"),
        docs["source"].alias("source"),
    )
    rows = cut(rows, "shard-rows")
    inner = (1 << bits) - 1
    # a bounded list: the quantiles that cut the sizes into 2**bits cells
    edges = rows.agg(F.percentile_approx("size", [(k + 1) / (inner + 1) for k in range(inner)], 10_000).alias("q")).first()["q"]
    cells = [quantile_cell(F.col("size"), edges or []), category_cell(F.col("source"), bits), category_cell(F.col("lang"), bits)]
    low_bits = max(0, bits * len(cells) - COARSE_BITS)
    rows = (
        with_hilbert(rows, cells, bits, "cell")
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(salts)).cast("int"))
        .select("doc_id", "size", "text_crc32", "cell", "salt")
    )
    rows = cut(rows, "shard-cells")
    counts = rows.groupBy("cell", "salt").agg(F.count("*").alias("n"))
    counts = counts.withColumn("run", F.shiftright("cell", low_bits))
    # at most 2**low_bits cells x `salts` rows to a run, at most 2**COARSE_BITS runs
    within = Window.partitionBy("run").orderBy("cell", "salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    runs = counts.groupBy("run").agg(F.sum("n").alias("run_n"))
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.select(
        "run", F.coalesce(F.sum("run_n").over(earlier), F.lit(0)).alias("before"), F.sum("run_n").over(whole).alias("total")
    )
    starts = counts.join(F.broadcast(runs), "run").select(
        "cell", "salt", (F.col("before") + F.col("inside")).alias("start"), "total"
    )
    order = Window.partitionBy("cell", "salt").orderBy("text_crc32", "size", "doc_id")
    ranked = rows.withColumn("rn", F.row_number().over(order)).join(starts, ["cell", "salt"])
    rank = F.col("start") + F.col("rn") - 1
    shard = F.expr(f"(start + rn - 1) * {shards} div total")
    return ranked.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        # the first rank of a shard is the least r with r * shards >= shard * total
        (rank - F.expr(f"(shard * total + {shards - 1}) div {shards}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
