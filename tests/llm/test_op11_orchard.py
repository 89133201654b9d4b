import hashlib
import math
import random

import numpy as np
import pytest

from llm_fixtures import same_rows
from wattlake.llm import orchard as M

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int, v string, n string"


def brute(rows, k, dims, rounds):
    keep = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(keep, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in keep]

    for _ in range(rounds):
        own = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(keep, own) if c == j]
            if mine:
                cents[j] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    return [(i, c, d, sum(x for x, y in own if y == c), sum(x for x, _ in own),
             hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
            for (i, _), (d, c) in zip(keep, own)]


def rows_of(seed, n, dims, spread=1.0):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-spread, spread) for _ in range(dims)] for _ in range(5)]
    return [(i, [float(np.float32(c + rnd.gauss(0, 0.2))) for c in centres[i % 5]]) for i in range(n)]


def run(spark, rows, k=8, dims=6, rounds=4):
    df = spark.createDataFrame([(i, v, "x", 1, "y", "z") for i, v in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in M.cluster(df, k=k, dims=dims, rounds=rounds).collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = rows_of(seed, 120, 6)
    same_rows(run(spark, rows), brute(rows, 8, 6, 4))


def test_bad_vectors_copies_ties_and_null_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0] * 6), (1, [0.0] * 6), (2, [0.5] * 6), (3, None), (4, [1.0] * 5), (5, [1.0] * 5 + [None]),
            (6, [nan] + [0.0] * 5), (7, [inf] + [0.0] * 5), (8, [-0.25] * 6), (None, [0.1] * 6), (9, []),
            *[(100 + i, [0.25] * 6) for i in range(40)]]
    same_rows(run(spark, rows, k=3), brute(rows, 3, 6, 4))


def test_far_vectors_stay_exact(spark):
    rows = [(i, [float(np.float32(x * 90000.0)) for x in v]) for i, v in rows_of(3, 40, 6)]
    same_rows(run(spark, rows, k=4), brute(rows, 4, 6, 4))


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = rows_of(4, 3, 6)
    same_rows(run(spark, rows, k=8), brute(rows, 8, 6, 4))
    got = M.cluster(spark.createDataFrame([], SCHEMA), dims=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got.collect() == []
    with pytest.raises(ValueError):
        M.cluster(spark.createDataFrame([], SCHEMA), k=0)


def test_the_walk_measures_few_centroids():
    """Marks and the stop rule: same answers as a full comparison, with fewer distances on separated centroids."""
    rng = np.random.default_rng(5)
    points = rng.integers(-10**6, 10**6, (60, 8))
    x = points[rng.integers(0, 60, 500)] + rng.integers(-1000, 1000, (500, 8))
    cents = M.Centroids.of(points.tolist())
    measured = [0]
    plain = M.squared

    def counted(a, b):
        measured[0] += len(a)
        return plain(a, b)

    M.squared = counted
    try:
        got, dist = M.nearest(x, cents)
    finally:
        M.squared = plain
    full = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (got == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()
    assert measured[0] < 500 * 60 * 0.75


def test_ties_go_to_the_smaller_number():
    cents = M.Centroids.of([[5, 0], [1, 0], [-1, 0], [1, 0]])
    got, dist = M.nearest(np.array([[0, 0], [1, 0], [3, 0]]), cents)
    assert got.tolist() == [1, 1, 0] and dist.tolist() == [1, 0, 4]
