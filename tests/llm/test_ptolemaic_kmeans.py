import hashlib

import numpy as np
import pytest

from tierline.llm import ptolemaic_kmeans as pk

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, dim, rounds, scale=64, seed=1):
    """Every distance computed, in Python integers."""
    kept = [(i, [int(np.floor(scale * float(np.float32(c)))) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [list(x) for _, x in sorted(kept, key=key)[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    for turn in range(rounds + 1):
        own = [min((far(x, c), j) for j, c in enumerate(centroids)) for _, x in kept]
        if turn < rounds:
            for j in range(len(centroids)):
                mine = [x for (_, x), (_, c) in zip(kept, own) if c == j]
                if mine:
                    centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    total = sum(d for d, _ in own)
    of = {j: sum(d for d, c in own if c == j) for _, j in own}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, of[j], total, sha[j]) for (i, _), (d, j) in zip(kept, own)), key=str)


def run(spark, rows, k, dim, rounds=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = pk.cluster(df, k=k, dim=dim, rounds=rounds)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def vectors(n, dim, seed, spread=3.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, dim)) * spread
    return [(i, [float(np.float32(v)) for v in middles[i % 5] + rng.normal(size=dim)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = vectors(120, 8, seed)
    assert run(spark, rows, 6, 8) == brute(rows, 6, 8, 3)


def test_dropped_rows_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(30, 4, 3) + [(100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, None, 2.0, 3.0]),
                                (104, [nan, 0.0, 0.0, 0.0]), (105, [inf, 0.0, 0.0, 0.0]), (None, [0.5] * 4),
                                (None, [0.5] * 4), (7, [0.5] * 4), (7, [0.25, -0.0, -0.01, 4.0])]
    rows += [(200 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(40)]
    assert run(spark, rows, 6, 4) == brute(rows, 6, 4, 3)


def test_equal_vectors_leave_later_centroids_empty(spark):
    rows = [(i, [1.0, -2.0]) for i in range(10)]
    got = run(spark, rows, 4, 2)
    assert got == brute(rows, 4, 2, 3) and {r[1] for r in got} == {0}


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.0, 0.0]), (2, [9.0, 9.0])]
    assert run(spark, rows, 16, 2) == brute(rows, 16, 2, 3)
    assert run(spark, [], 16, 2) == []
    assert run(spark, [(1, None)], 16, 2) == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(np.float32((-1) ** i * 1e9 + 4096 * i * 64)), 3e8]) for i in range(12)]
    want = brute(rows, 3, 2, 3)
    got = run(spark, rows, 3, 2)
    fit = lambda v: v if v < 1 << 63 else None
    assert got == sorted(((i, j, fit(d), fit(s), fit(t), h) for i, j, d, s, t, h in want), key=str)


def test_other_columns_are_not_read(spark):
    rows = vectors(40, 4, 5)
    df = spark.createDataFrame([(i, v, "a", 1.0) for i, v in rows], SCHEMA + ", x string, near double")
    assert sorted((tuple(r) for r in pk.cluster(df, k=4, dim=4).collect()), key=str) == brute(rows, 4, 4, 3)


def test_bounds_are_below_the_distances_and_leave_centroids_out():
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(400, 64)) * 20).astype(np.int64) + (np.arange(400) % 8)[:, None] * 100
    pivots, centroids = x[:16], x[100:116] + 1
    near, of, pairs = pk.pivot_distances(x, pivots), pk.pivot_distances(centroids, pivots), pk.pairs_of(pivots)
    exact = np.array([pk.squares(x, c) for c in centroids]).T
    assert (pk.lower_bounds(near, of, pairs) <= exact).all()
    cluster, distance, checks = pk.nearest(x, near, centroids, of, pairs)
    assert (distance == exact.min(axis=1)).all() and (cluster == exact.argmin(axis=1)).all()
    assert checks < 0.6 * exact.size  # of 16 a vector


def test_a_point_at_the_bound_is_still_checked():
    """Points of a line meet the bound with equality: rounding must never leave a nearer one out."""
    x = np.array([[i, 0] for i in range(-300, 300, 7)], np.int64)
    pivots = np.array([[0, 0], [1000, 0], [77, 0]], np.int64)
    centroids = np.array([[i, 0] for i in (-299, -3, 4, 11, 150)], np.int64)
    got = pk.nearest(x, pk.pivot_distances(x, pivots), centroids, pk.pivot_distances(centroids, pivots), pk.pairs_of(pivots))
    exact = np.array([pk.squares(x, c) for c in centroids]).T
    assert (got[0] == exact.argmin(axis=1)).all() and (got[1] == exact.min(axis=1)).all()
