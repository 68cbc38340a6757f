import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from orderlens.llm import centroid_clusters as op


@pytest.fixture
def vectors(session):
    def build(rows):
        return session.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, distance string")

    return build


def brute_force(rows, k, rounds, dims, steps, salt):
    kept = [(i, [math.floor(steps * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"{salt}{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centroids = [v for _, v in named[:k]]
    apart = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min((apart(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, own in groups.items():
            centroids[n] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centroids


@pytest.mark.parametrize("grid", [1, 4, 400])
def test_equals_brute_force(vectors, grid):
    """On a coarse grid most vectors are as near to several centroids."""
    rng = random.Random(grid)
    rows = [(i, [rng.randint(-grid, grid) / 8 for _ in range(3)]) for i in range(400)]
    rows += [(rng.randrange(400), rows[k][1]) for k in range(40)]
    found, clusters = op.cluster(vectors(rows), k=25, rounds=3, dims=3, steps=16, salt="s")
    expected, centroids = brute_force(rows, 25, 3, 3, 16, "s")
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    told = {r["cluster"]: r for r in clusters.collect()}
    assert [told[n]["centroid"] for n in range(25)] == centroids
    for n in range(25):
        own = [d for _, c, d in expected if c == n]
        assert (told[n]["n"], told[n]["inertia"]) == (len(own), sum(own) if own else None)


@pytest.mark.parametrize(("scale", "spread"), [(5, 0), (1000, 5), (1 << 26, 1 << 20)])
def test_tree_finds_the_first_of_the_nearest(scale, spread):
    rng = np.random.default_rng(scale)
    points = np.repeat(rng.integers(-scale, scale + 1, (30, 8)), 3, axis=0) + rng.integers(-spread, spread + 1, (90, 8))
    vectors = np.concatenate([points, rng.integers(-scale, scale + 1, (3000, 8))])
    which, best = op.nearest(vectors, op.build_tree(points))
    apart = np.stack([((vectors - p) ** 2).sum(axis=1) for p in points], axis=1)
    assert (best == apart.min(axis=1)).all() and (which == apart.argmin(axis=1)).all()


def test_tree_leaves_nodes_out():
    """Vectors near one of far apart groups of centroids do not see the others."""
    rng = np.random.default_rng(3)
    points = rng.integers(0, 100, (60, 4)) + (np.arange(60) % 6 * 100_000)[:, None]
    tree = op.build_tree(points)
    seen = []
    plain = op.distances
    try:
        op.distances = lambda v, p: seen.append(len(v) * len(p)) or plain(v, p)
        op.nearest(points, tree)
    finally:
        op.distances = plain
    assert sum(seen) < 0.6 * 60 * 60


def test_edge_cases(vectors):
    good = [0.5, -0.25]
    rows = [(1, good), (1, good), (None, good), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 0.0]), (None, [7.0, 7.0]), (8, [])]
    found, clusters = op.cluster(vectors(rows), k=5, rounds=2, dims=2)
    # Two equal rows are the first centroids. The first gets all vectors and moves away, the second keeps its place.
    expected, _ = brute_force(rows, 5, 2, 2, 256, "2:")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str) and len(expected) == 4
    assert [(r["cluster"], r["n"]) for r in clusters.orderBy("cluster").collect()] == [(0, 1), (1, 3)]
    for none in ([], rows[3:8], [(None, good)]):
        found, clusters = op.cluster(vectors(none), dims=2)
        assert found.columns == ["vec_id", "cluster", "distance"] and found.collect() == [] and clusters.collect() == []
    with pytest.raises(PySparkException, match="steps"):
        op.cluster(vectors([(1, [1e6, 0.0])]), dims=2)
