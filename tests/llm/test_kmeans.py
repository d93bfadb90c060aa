"""Clustering against plain Python integers, and what odd rows give."""

import hashlib
import math

import numpy as np

from cellweave.llm.kmeans import clusters, kmeans, nearest

SCHEMA = "vec_id long, embedding array<double>, cluster string, x string, n string"


def brute(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * v) for v in e]) for i, e in rows if e is not None and len(e) == 64 and all(v is not None and math.isfinite(v) for v in e)]
    cent = [x for _, x in sorted(kept, key=lambda r: hashlib.sha256(f"1:{r[0]}".encode()).hexdigest())[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(cent)) for _, x in kept]

    for _ in range(rounds):
        at = assign()
        for j in range(len(cent)):
            mine = [x for (_, x), (_, c) in zip(kept, at, strict=True) if c == j]
            if mine:
                cent[j] = [sum(v) // len(mine) for v in zip(*mine, strict=True)]
    at = assign()
    total = sum(d for d, _ in at)
    each = {j: sum(d for d, c in at if c == j) for j in range(len(cent))}
    return sorted((i, c, d, each[c], total, hashlib.sha256(",".join(map(str, cent[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, at, strict=True))


def test_partial_distances_are_exact():
    """Also where centroids are equal or at equal distances, whatever the order of the dimensions."""
    rng = np.random.default_rng(5)
    for spread in (2, 50):
        x, c = rng.integers(-spread, spread, (500, 64)), rng.integers(-spread, spread, (9, 64))
        x[:, 8:] //= 3
        c[4] = c[2]
        which, best = nearest(x, c, rng.permutation(64))
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (best == d.min(axis=1)).all() and (which == d.argmin(axis=1)).all()


def test_clusters_equal_brute_force_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in rng.normal(0, 0.3, 64)]) for i in range(300)]
    rows += [(int(1000 + i), rows[0][1]) for i in range(150)]  # a third of all are copies of one
    odd = [(2000, None), (2001, []), (2002, [0.1] * 63), (2003, [0.1] * 63 + [None]), (2004, [math.nan] + [0.1] * 63), (2005, [math.inf] + [0.1] * 63), (2006, [0.0] * 64), (2007, [-1e-9] * 64)]
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows + odd], SCHEMA).repartition(7)
    got = sorted(tuple(r) for r in clusters(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())
    assert got == brute(rows + odd)


def test_few_equal_and_no_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert clusters_of(none) == [] and kmeans(none)[1].shape == (0, 64)
    rows = [(1, [0.5] * 64, "", "", ""), (1, [0.5] * 64, "", "", ""), (None, [0.25] * 64, "", "", ""), (3, [1e30] * 64, "", "", "")]
    got = clusters_of(spark.createDataFrame(rows, SCHEMA))
    assert [(r.vec_id, r.cluster, r.distance) for r in got] == [(None, 2, 0), (1, 0, 0), (1, 0, 0)]  # equal centroids: the first; none fits 1e30



def clusters_of(df):
    return sorted(clusters(df).collect(), key=lambda r: (r.vec_id is not None, r.vec_id))
