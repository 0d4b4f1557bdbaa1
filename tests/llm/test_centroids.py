"""Heap-ordered k-means against a full scan in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from snapkeep.llm import centroids as ce
from snapkeep.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, label int, x int, cluster string, e string"


def plain(rows, k=8, rounds=10, dim=64):
    """Sorted (vec_id, cluster, distance, cluster_inertia, inertia, sha)."""
    kept = [
        (i, [math.floor(min(max(1024 * x, -ce.LIMIT), ce.LIMIT)) for x in e]) for i, e in rows
        if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)
    ]
    text = lambda i: f"3:{'' if i is None else i}"
    cents = [x for _, x in sorted(kept, key=lambda r: (hashlib.sha256(text(r[0]).encode()).hexdigest(), r[1]))[:k]]

    def assign():
        out = []
        for _, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cents]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(rounds):
        a = assign()
        for j in range(len(cents)):
            mine = [x for (_, x), (_, c) in zip(kept, a) if c == j]
            if mine:
                cents[j] = [sum(v) // len(mine) for v in zip(*mine)]
    a = assign()
    per = [sum(d for d, c in a if c == j) for j in range(len(cents))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    top = ce.LARGEST
    return sorted(
        ((i, c, d, min(per[c], top), min(sum(min(p, top) for p in per), top), sha[c]) for (i, _), (d, c) in zip(kept, a)), key=str)


def results(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, 2, "c", "e") for i, e in rows], SCHEMA).repartition(3)


def vectors(n, seed, dim=64, spread=0.2):
    rnd = random.Random(seed)
    tops = [[rnd.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, [t + rnd.gauss(0, spread) for t in rnd.choice(tops)]) for i in range(n)]


@pytest.mark.parametrize("block", [7, ce.BLOCK])
def test_equals_full_scan(ship, monkeypatch, block):
    monkeypatch.setattr(ce, "BLOCK", block)
    rows = vectors(300, block, spread=0.6)
    rows += [(1000 + i, rows[5][1]) for i in range(40)] + [(7, rows[9][1]), (None, rows[3][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [None] + [1.0] * 63), (2004, [math.nan] * 64), (2005, [math.inf] + [0.0] * 63)]
    assert results(ce.cluster_vectors(frame(ship, rows))) == plain(rows)


def test_ties_between_centroids(ship):
    rnd = random.Random(1)
    rows = [(i, [rnd.choice([0.0, 1 / 1024, -1 / 1024]) if j < 4 else 0.0 for j in range(64)]) for i in range(120)]
    assert results(ce.cluster_vectors(frame(ship, rows))) == plain(rows)


def test_large_components(ship):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([1.0, 5e3, -7e4, 1e30]) * rnd.random() for _ in range(64)]) for i in range(60)]
    assert results(ce.cluster_vectors(frame(ship, rows))) == plain(rows)


def test_few_and_none(ship):
    assert ce.cluster_vectors(frame(ship, [])).collect() == []
    assert ce.cluster_vectors(frame(ship, [(1, [0.5])])).collect() == []
    rows = vectors(3, 4)
    assert results(ce.cluster_vectors(frame(ship, rows))) == plain(rows)
    same = [(i, rows[0][1]) for i in range(30)]
    assert results(ce.cluster_vectors(frame(ship, same))) == plain(same)


def test_bounds_save_scans(ship):
    scanned = []
    rows = vectors(2000, 6, spread=0.05)
    ce.cluster_vectors(frame(ship, rows), scanned=scanned).count()
    assert len(scanned) == 11 and scanned[0] == 2000
    assert sum(scanned[4:]) < 0.3 * 2000 * len(scanned[4:])


def test_query_on_the_table(ship):
    d = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in ship.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op11_centroid_clusters"](ship, d)
    assert results(got) == plain(rows)


def test_exact_distances_in_both_ranges():
    rng = np.random.default_rng(0)
    for top in (1000, ce.FLOAT_LIMIT, ce.LIMIT):
        x, c = rng.integers(-top, top + 1, (50, 64)), rng.integers(-top, top + 1, (8, 64))
        got = ce.exact_distances(x.astype(np.int32), c)
        assert got.tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
