"""Exact k-means by heap-ordered bounds.

Each cluster keeps a heap of its vectors, keyed by the gap between the
distance to the second nearest and to the nearest centroid when the vector was
last looked at, plus the drift its cluster had accumulated by then.  A round
adds to a cluster's drift its own centroid's move and the largest move of any
other; only vectors whose key the drift has reached can have a new nearest
centroid.  They are popped, their distances computed exactly in integers, and
pushed again.  A vector that stays in the heap is strictly nearer to its
centroid than to any other, so the result is that of a full scan, ties (to the
smaller number) included: bounds are compared with a margin above their
rounding error and an equal gap is always scanned.

Scale.  Vectors lie in blocks of at most `BLOCK` (one row each: components as
16- or 32-bit integers, clusters, heaps); a round is a map over the blocks
without a shuffle, and every block carries its clusters' counts and sums,
changed only for moved vectors.  The driver sees k x (components + 1) totals a
round.  The blocks of a round are written to the shared checkpoint folder,
so a lost executor repeats a part of one round; the round before is deleted.

Defined cases.  Vectors that are null, of another length, or hold a null, NaN
or infinite component are left out.  A component whose integer is beyond
+-2^27 (a value beyond 131,072) is taken at that bound, since squared
distances would not fit a long; sums of distances stop at the largest long.  A null
vec_id is kept, with the empty text in its hash.  Rows of one vec_id are
vectors of their own; equal hashes go by components.  With fewer than `k`
vectors each is a centroid; without any the result is empty.  A vec_id has no
part in distances, so repeated vectors and ties need no rule but the smaller
number.  Other columns are dropped at the start.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapkeep.session import remove_path, scratch_path

DIM = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
#: Vectors of one block, so of one set of heaps.
BLOCK = 4096
#: Bound of a component; 64 squared differences of twice this fit a long.
LIMIT = 1 << 27
#: Components up to this make every product sum exact in doubles.
FLOAT_LIMIT = 1 << 22
LARGEST = (1 << 63) - 1
NONE = 255

STATE = ("vec_id array<long>, x binary, width int, cluster binary, sizes array<int>, keys binary, members binary, "
         "totals array<long>, far array<decimal(38,0)>")
RESULT = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")


def integer_vectors(embeddings: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and the `dim` integers floor(scale * x) of every usable vector."""
    e = embeddings["embedding"].cast("array<double>")
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), e.alias("e")).where(
        (F.size("e") == dim)
        & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    whole = F.transform(
        "e", lambda x: F.floor(F.least(F.greatest(x * F.lit(float(scale)), F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int")
    )
    return rows.select("vec_id", whole.alias("x"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The `k` vectors of least hash; `k` rows come to the driver."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(text, 256).alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return [list(r["x"]) for r in rows]


def exact_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (rows x centroids) as exact 64-bit integers."""
    if not len(x):
        return np.zeros((0, len(centroids)), dtype=np.int64)
    if max(np.abs(x).max(), np.abs(centroids).max()) <= FLOAT_LIMIT:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        # every term is an integer below 2^53: no rounding in any order
        return ((a * a).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (a @ c.T)).astype(np.int64)
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    wide = x.astype(np.int64)
    for j, c in enumerate(centroids.astype(np.int64)):
        d = wide - c
        out[:, j] = (d * d).sum(1)
    return out


class Block:
    """Vectors with their clusters, heaps and totals."""

    def __init__(self, x: np.ndarray, cluster: np.ndarray, heaps: list[list[tuple[float, int]]], totals: np.ndarray):
        self.x, self.cluster, self.heaps, self.totals = x, cluster, heaps, totals

    @classmethod
    def new(cls, x: np.ndarray, k: int) -> Block:
        """All vectors expired, in no cluster."""
        return cls(x, np.full(len(x), NONE, np.uint8), [[(-np.inf, i) for i in range(len(x))]] + [[] for _ in range(k - 1)],
                   np.zeros(k * (x.shape[1] + 1) + 1, np.int64))

    def advance(self, centroids: np.ndarray, drift: np.ndarray) -> None:
        """Assign every vector to its nearest of `centroids`.

        `drift` is what each cluster has accumulated by now.  The last total counts
        the vectors scanned.
        """
        k, dim = centroids.shape
        expired: list[int] = []
        for c, heap in enumerate(self.heaps):
            # the key is a sum of square roots of integers; its rounding is far below this
            reach = drift[c] + 1e-6 + 1e-9 * abs(drift[c])
            while heap and heap[0][0] <= reach:
                expired.append(heapq.heappop(heap)[1])
        self.totals[-1] += len(expired)
        if not expired:
            return
        at = np.array(sorted(expired))
        d = exact_distances(self.x[at], centroids)
        near = d.argmin(1)  # the first of equal ones
        if k > 1:
            two = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
            gap = (two[:, 1] - two[:, 0]) * (1 - 1e-12)
        else:
            gap = np.full(len(at), np.inf)
        before = self.cluster[at]
        moved = before != near
        counts, sums = self.totals[:k], self.totals[k:-1].reshape(k, dim)
        rows = self.x[at[moved]].astype(np.int64)
        old, new = before[moved], near[moved]
        was = old != NONE
        np.add.at(counts, new, 1)
        np.add.at(sums, new, rows)
        np.subtract.at(counts, old[was], 1)
        np.subtract.at(sums, old[was], rows[was])
        self.cluster[at] = near
        for key, i, c in zip((gap + drift[near]).tolist(), at.tolist(), near.tolist()):
            heapq.heappush(self.heaps[c], (key, i))

    def row(self) -> tuple:
        """The heaps are written as they lie, so reading them needs no ordering."""
        pairs = [p for heap in self.heaps for p in heap]
        width = self.x.dtype.itemsize
        return (self.x.astype(f"<i{width}").tobytes(), width, self.cluster.tobytes(), [len(h) for h in self.heaps],
                np.array([p[0] for p in pairs], "<f8").tobytes(), np.array([p[1] for p in pairs], "<i4").tobytes(),
                self.totals.tolist())

    @classmethod
    def read(cls, dim: int, x: bytes, width: int, cluster: bytes, sizes: list[int], keys: bytes, members: bytes,
             totals: list[int]) -> Block:
        pairs = list(zip(np.frombuffer(keys, "<f8").tolist(), np.frombuffer(members, "<i4").tolist()))
        heaps, start = [], 0
        for n in sizes:
            heaps.append(pairs[start:start + n])
            start += n
        return cls(np.frombuffer(x, f"<i{width}").reshape(-1, dim), np.frombuffer(cluster, np.uint8).copy(), heaps,
                   np.array(totals, np.int64))


_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_STATE = pa.schema([
    ("vec_id", _LONGS), ("x", pa.binary()), ("width", pa.int32()), ("cluster", pa.binary()), ("sizes", _INTS),
    ("keys", pa.binary()), ("members", pa.binary()), ("totals", _LONGS), ("far", pa.list_(pa.decimal128(38, 0))),
])


def _state_row(vec_id: pa.Array, block: Block, far: list[int]) -> pa.RecordBatch:
    values = [*block.row(), [Decimal(v) for v in far]]
    return pa.RecordBatch.from_arrays(
        [vec_id, *[pa.array([v], t) for v, t in zip(values, _STATE.types[1:])]], schema=_STATE)


def make_blocks(vectors: DataFrame, k: int, dim: int = DIM) -> DataFrame:
    """Rows of state, no vector assigned yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = part.column(1).flatten().to_numpy().reshape(-1, dim)
                small = np.abs(x).max() < 1 << 15
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.concat_arrays([part.column(0)]))
                yield _state_row(ids, Block.new(x.astype(np.int16 if small else np.int32), k), [0] * k)

    return vectors.mapInArrow(run, STATE)


def assign_blocks(state: DataFrame, centroids: list[list[int]], drift: list[float], measure: bool = False) -> DataFrame:
    """One round over the blocks; `measure` adds the clusters' distance sums."""
    dim = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, moved = np.array(centroids, np.int64), np.array(drift)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                block = Block.read(dim, *[row.column(i)[0].as_py() for i in range(1, 8)])
                block.advance(c, moved)
                far = [0] * len(c)
                if measure:
                    near = _near(block, c)
                    far = [sum(near[block.cluster == j].tolist()) for j in range(len(c))]
                yield _state_row(row.column(0), block, far)

    return state.mapInArrow(run, STATE)


def _near(block: Block, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each vector to its own centroid."""
    out = np.empty(len(block.x), np.int64)
    for j in range(len(centroids)):
        at = np.flatnonzero(block.cluster == j)
        out[at] = exact_distances(block.x[at], centroids[j:j + 1])[:, 0]
    return out


def _totals(state: DataFrame, column: str) -> list[int]:
    """Sums over all blocks of the array's places (one row a place)."""
    rows = (
        state.select(F.posexplode(column).alias("place", "v"))
        .groupBy("place").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    )
    return [int(r["v"]) for r in sorted(rows)]


def _moved(old: list[list[int]], new: list[list[int]]) -> list[float]:
    """Upper bounds of the clusters' drift in one round."""
    far = [float(np.sqrt(float(sum((a - b) ** 2 for a, b in zip(p, q))))) * (1 + 1e-12) for p, q in zip(old, new)]
    return [m + max([f for i, f in enumerate(far) if i != j], default=0.0) for j, m in enumerate(far)]


def cluster_vectors(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM,
                    scale: int = SCALE, seed: int = SEED, scanned: list[int] | None = None) -> DataFrame:
    """One row per usable vector with its cluster after `rounds` rounds.

    `scanned`, if given, receives the number of vectors scanned in each pass.
    """
    spark = embeddings.sparkSession
    vectors = integer_vectors(embeddings, dim, scale)
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        return spark.createDataFrame([], RESULT)
    k = len(centroids)
    state, held = make_blocks(vectors, k, dim), None
    drift = [0.0] * k
    seen = 0
    for n in range(rounds + 1):
        # kept as a written table: the next round and retries read it
        path = scratch_path(spark, f"clusters-{n}")
        assign_blocks(state, centroids, drift, measure=n == rounds).write.parquet(path)
        state = spark.read.schema(state.schema).parquet(path)
        if held:
            remove_path(spark, held)
        held = path
        totals = _totals(state, "totals")
        if scanned is not None:
            scanned.append(totals[-1] - seen)
            seen = totals[-1]
        if n == rounds:
            break
        new = [
            [s // totals[j] for s in totals[k + j * dim:k + (j + 1) * dim]] if totals[j] else centroids[j]
            for j in range(k)
        ]
        drift = [a + b for a, b in zip(drift, _moved(centroids, new))]
        centroids = new
    inertia = [min(v, LARGEST) for v in _totals(state, "far")]
    total = min(sum(inertia), LARGEST)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.array(centroids, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                block = Block.read(dim, *[row.column(i)[0].as_py() for i in range(1, 8)])
                of = block.cluster.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [row.column(0).flatten(), pa.array(of.astype(np.int32)), pa.array(_near(block, c)),
                     pa.array(np.array(inertia, np.int64)[of]), pa.array(np.full(len(of), total, np.int64)),
                     pa.array([names[j] for j in of], pa.string())],
                    names=[f.split()[0] for f in RESULT.split(", ")])

    return state.mapInArrow(rows, RESULT)


def clusters_sql(k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> str:
    """The same by full scans, as SQL: one pair of steps a round."""
    steps = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}
)""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS k, x AS c
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, x FROM v ORDER BY h LIMIT {k})
)"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x) AS x, min({{'d': d, 'k': k}}) AS near
  FROM (SELECT r, vec_id, x, k, list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{r})
  GROUP BY r
)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.k, coalesce(n.c, c{r}.c) AS c
  FROM c{r} LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (SELECT near.k AS k, i, sum(x[i]) AS s, count(*) AS n
          FROM (SELECT near, x, unnest(range(1, {dim + 1})) AS i FROM a{r}) GROUP BY 1, 2)
    GROUP BY k) n ON n.k = c{r}.k
)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(near.k AS INTEGER) AS cluster, CAST(near.d AS BIGINT) AS distance,
       CAST(sum(near.d) OVER (PARTITION BY near.k) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.k = near.k
"""
