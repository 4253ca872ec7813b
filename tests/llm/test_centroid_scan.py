import hashlib
import math
import random

import numpy as np
import pytest

from topicloom.llm import centroid_scan as C

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, x string"


def brute(rows, k, rounds, dimension):
    """Full comparison in Python integers."""
    kept = [(i, [math.floor(256 * v) for v in e]) for i, e in rows if e is not None and len(e) == dimension and all(v is not None and math.isfinite(v) for v in e)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)
    centroids = [x for _, x in named[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        centroids = [[sum(v) // len(groups[n]) for v in zip(*groups[n])] if n in groups else c for n, c in enumerate(centroids)]
    return [(i, *nearest(x)[::-1]) for i, x in kept], centroids


@pytest.fixture
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, e, 0, 7, "x") for i, e in rows], SCHEMA)

    return build


def some(n, dimension, seed=1):
    rng = random.Random(seed)
    centres = [[float(np.float32(rng.gauss(0, 1))) for _ in range(dimension)] for _ in range(5)]
    return [(i, [float(np.float32(v + rng.gauss(0, 0.4))) for v in rng.choice(centres)]) for i in range(n)]


def check(found, centroids, rows, k, rounds, dimension):
    expected, points = brute(rows, k, rounds, dimension)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)
    about = centroids.orderBy("cluster").collect()
    assert [r.centroid for r in about] == points
    assert [r.size for r in about] == [sum(e[1] == n for e in expected) for n in range(len(points))]
    assert [r.cluster_inertia for r in about] == [sum(e[2] for e in expected if e[1] == n) for n in range(len(points))]
    assert {r.inertia for r in about} <= {sum(e[2] for e in expected)}


def test_like_full_comparison(vectors):
    rows = some(300, 8)
    table = vectors(rows).repartition(5)
    check(*C.cluster(table, k=12, rounds=3, dimension=8), rows, 12, 3, 8)


def test_odd_rows(vectors):
    """Nulls, wrong lengths, non-finite components, repeated rows, a missing id, and many equal vectors."""
    rows = some(20, 4) + [(100, None), (101, []), (102, [1.0, 2.0, 3.0]), (103, [1.0, None, 2.0, 3.0]), (104, [math.nan, 0.0, 0.0, 0.0])]
    rows += [(105, [math.inf, 0.0, 0.0, 0.0]), (None, [0.5, 0.5, 0.5, 0.5]), (3, rows[3][1])] + [(200 + i, [0.25, -0.25, 0.0, 1.0]) for i in range(60)]
    check(*C.cluster(vectors(rows), k=30, rounds=4, dimension=4), rows, 30, 4, 4)


def test_fewer_vectors_than_centroids(vectors):
    rows = some(3, 4)
    check(*C.cluster(vectors(rows), k=10, dimension=4), rows, 10, 5, 4)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, [1.0, 2.0])]])
def test_nothing_to_start_from(vectors, rows):
    found, centroids = C.cluster(vectors(rows), dimension=2)
    assert found.columns == ["vec_id", "cluster", "distance"] and not found.count() and not centroids.count()


def test_ties_go_to_the_smaller_number():
    scan = C.Scan(np.array([[2, 0], [0, 2], [0, 0], [0, 0]]))
    found, distance, _ = scan.nearest(np.array([[1, 1], [0, 0], [2, 2]]))
    assert found.tolist() == [0, 2, 0] and distance.tolist() == [2, 0, 4]


def test_inequalities_leave_out_most_and_nothing_else():
    rng = np.random.default_rng(3)
    points = rng.integers(-300, 300, (40, 1)) + rng.integers(-60, 60, (40, 16))
    x = points[rng.integers(0, 40, 2000)] + rng.integers(-40, 40, (2000, 16))
    found, distance, measured = C.Scan(points).nearest(x)
    whole = ((x[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (found == whole.argmin(axis=1)).all() and (distance == whole.min(axis=1)).all()
    assert measured < whole.size / 4


def test_largest_components():
    most = (1 << 30) // 4
    points = np.array([[most] * 4, [-most] * 4, [most, -most, most, -most]])
    found, distance, _ = C.Scan(points).nearest(-points)
    whole = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in points] for x in -points]
    assert found.tolist() == [row.index(min(row)) for row in whole] and distance.tolist() == [min(row) for row in whole]


def test_components_out_of_reach(vectors):
    with pytest.raises(Exception, match="smaller scale"):
        C.cluster(vectors([(1, [1e9, 0.0])]), dimension=2)
