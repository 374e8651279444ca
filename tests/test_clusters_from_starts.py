"""k-means with given starts, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from streetloom.operators import cluster


def _plain(points, k, steps):
    """Centres of standardised (x, y) rows."""
    n = len(points)
    mean = [sum(p[i] for p in points) / n for i in (0, 1)]
    sd = [(sum((p[i] - mean[i]) ** 2 for p in points) / n) ** 0.5 or 1.0 for i in (0, 1)]
    z = [tuple((p[i] - mean[i]) / sd[i] for i in (0, 1)) for p in points]
    far = lambda a, b: round((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2, 9)
    order = sorted(range(n), key=lambda i: points[i])
    centers = []
    for _ in range(k):
        centers.append(z[max(order, key=lambda i: (min(far(z[i], c) for c in centers or [(0, 0)]), [-v for v in points[i]]))])
    for _ in range(steps):
        nearest = [min(range(k), key=lambda j: (far(p, centers[j]), j)) for p in z]
        for j in range(k):
            own = [p for p, at in zip(z, nearest) if at == j]
            if own:
                centers[j] = tuple(sum(p[i] for p in own) / len(own) for i in (0, 1))
    return z, sorted(centers), sum(min(far(p, c) for c in centers) for p in z)


@pytest.fixture(scope="module")
def points():
    rng = random.Random(4)
    return [(round(rng.random(), 2), rng.choice([0.0, 0.4, 0.9])) for _ in range(400)]


@pytest.fixture(scope="module")
def scored(spark, points):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, proximity_score double, category_similarity double")


def test_elbow_equals_plain_loops(scored, points):
    got = {r.k: r.inertia for r in cluster.elbow_from_farthest(scored, ks=(2, 3, 5), steps=4).collect()}
    assert got == pytest.approx({k: _plain(points, k, 4)[2] for k in (2, 3, 5)}, abs=1e-6)


def test_labels_equal_plain_loops(scored, points):
    z, centers, _ = _plain(points, 4, 10)
    far = lambda a, b: round((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2, 9)
    want = {i: min(range(4), key=lambda j: (far(p, centers[j]), j)) for i, p in enumerate(z)}
    assert {r.id: r.cluster for r in cluster.assign_from_farthest(scored).collect()} == want


def test_few_and_no_points(spark, scored):
    two = spark.createDataFrame([(0.1, 0.5), (0.9, 0.5), (0.9, 0.5), (None, 0.5)], "proximity_score double, category_similarity double")
    got = cluster.assign_from_farthest(two, k=4).groupBy("cluster").count().orderBy("cluster").collect()
    assert [tuple(r) for r in got] == [(0, 1), (1, 2)]
    none = scored.where(F.lit(False))
    assert cluster.assign_from_farthest(none).count() == 0
    assert cluster.elbow_from_farthest(none).count() == 0
