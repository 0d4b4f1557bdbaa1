"""Connected components of a distributed edge list.

First every block of at most BLOCK_EDGES edges is contracted by its own task
to stars (least node of each local component); the number of blocks follows
the number of edges, so a task's share is bounded.  One block is then done;
several are joined by alternating star contraction: a large-star step links every larger neighbour
of a node to the smallest node it knows, a small-star step does so for its
smaller neighbours.  Edges only ever move towards smaller nodes, and after a
logarithmic number of rounds each component is a star around its least node.
Minima are grouped aggregates (combined before the shuffle) joined back, so a
node with very many edges is split like any skewed join key; every round is
written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapkeep.llm.frames import cut


#: Edges that one task contracts at most (16 bytes each).
BLOCK_EDGES = 1_000_000


def local_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) for all but the least nodes."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[:len(u)], index[len(u):]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while (label[label] != label).any():
            label = label[label]
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    us, vs = [], []
    for batch in batches:
        us.append(batch.column(0).to_numpy())
        vs.append(batch.column(1).to_numpy())
    if us:
        u, v = local_stars(np.concatenate(us), np.concatenate(vs))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _least(edges: DataFrame) -> DataFrame:
    """edges(u, v) with the least of u and its neighbours as column m."""
    m = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(m, "u").withColumn("m", F.least("u", "m"))


def _sum(edges: DataFrame) -> tuple:
    """Row count and an order-free fingerprint; two edge sets compare equal by it."""
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges(u, v)`, root its least node.

    Nodes without an edge do not appear; self-loops and repeated edges are
    allowed; no edges give an empty table.
    """
    edges = edges.select("u", "v").where("u <> v")
    blocks = -(-edges.count() // BLOCK_EDGES)
    edges = cut(edges.repartition(max(1, blocks)).mapInArrow(_contract, "u long, v long"), "edges")
    mark = _sum(edges) if blocks > 1 else (0, None)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        star = _least(down)
        small = star.select("v", "m").unionByName(star.select(F.col("u").alias("v"), "m"))
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = cut(small, "edges")
        now = _sum(edges)
        if now == mark:
            break
        mark = now
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")))
        .distinct()
    )
