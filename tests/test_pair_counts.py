"""Counted pairs against the pairs themselves."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streetloom.operators import pair_counts as pair_counts_module
from streetloom.operators import reports
from streetloom.operators.pair_counts import pair_counts
from streetloom.operators.radius import radius_join
from streetloom.dimensions import default_affinity
from streetloom.plans.integration import match_pairs
from test_operators import business_table, request_table, rows


def _tables(spark, centre, spread, sizes, seed):
    rng = random.Random(seed)
    wrap = lambda lon: (lon + 180) % 360 - 180

    def place():
        return min(90.0, max(-90.0, centre[0] + rng.uniform(-spread, spread))), wrap(centre[1] + rng.uniform(-spread, spread))

    odd = [(None, 1.0), (1.0, None), (float("nan"), 1.0)]
    left = [(rng.choice(["a", "b", None]), *at) for at in [*(place() for _ in range(sizes[0])), *odd]]
    right = [(rng.choice([1, 2, None]), rng.choice([["x"], ["x", "y"], [], None]), *at) for at in [*(place() for _ in range(sizes[1])), *odd]]
    return (
        spark.createDataFrame(left, "kind string, lat double, lon double"),
        spark.createDataFrame(right, "n int, tags array<string>, latitude double, longitude double"),
    )


@pytest.mark.parametrize("hot", [30, 200_000])
@pytest.mark.parametrize(
    ("centre", "spread", "radius", "sizes"),
    [
        ((40.0, -75.0), 0.01, 250, (700, 300)),  # one dense cell or a few
        ((40.0, -75.0), 0.002, 250, (300, 200)),  # most pairs are within
        ((40.0, -75.0), 0.3, 2_000, (400, 200)),  # many cells
        ((10.0, 180.0), 0.05, 3_000, (400, 200)),  # date line
        ((90.0, 0.0), 0.02, 1_000, (400, 200)),  # pole
        ((0.0, 0.0), 80.0, 3_000_000, (200, 100)),
    ],
)
def test_counts_are_those_of_the_pairs(spark, centre, spread, radius, sizes, hot):
    left, right = _tables(spark, centre, spread, sizes, 7)
    by = ["kind", "n", "tags"]
    want = radius_join(left, right, radius).groupBy(*by).agg(F.count("*").alias("n_pairs"))
    got = pair_counts(left, right, ["kind"], ["n", "tags"], radius, hot_cell_rows=hot)
    got = got.groupBy(*by).agg(F.sum("n_pairs").alias("n_pairs"))
    assert got.columns == [*by, "n_pairs"]
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(got) == order(want) and want.count()


def test_pairs_at_the_radius_are_decided_by_their_distance(spark):
    left = spark.createDataFrame([("a", 0.0, 0.0)], "kind string, lat double, lon double")
    right = spark.createDataFrame([(i, 0.0, 0.002 + i * 1e-13) for i in range(-20, 21)], "n int, latitude double, longitude double")
    edge = radius_join(left, right, 1_000).where("n = 0").first().distance
    want = radius_join(left, right, edge).count()
    assert 0 < want < 41
    assert pair_counts(left, right, ["kind"], ["n"], edge).count() == want


def test_reports_on_counts_equal_those_on_pairs(spark):
    rng = random.Random(3)
    place = lambda: (40 + rng.random() / 100, -75 + rng.random() / 100)
    kinds = ["salting", "x", None]
    requests = request_table(spark, [(rng.choice([1, None, 5 + i]), rng.choice(kinds), *place()) for i in range(60)])
    requests = requests.withColumn("zipcode", F.when(F.col("lat") < 40.004, "19104").when(F.col("lat") < 40.008, "19105"))
    businesses = business_table(spark, [(rng.choice([1, None, 5 + i]), rng.choice(["Pets", None]), *place()) for i in range(80)])
    affinity = default_affinity(spark)
    pairs = match_pairs(requests, businesses, affinity)
    counted = lambda *by: match_pairs(requests, businesses, affinity, counted_by=by)
    same = [
        (reports.top_values(counted("service_name"), "service_name", 2, "n_pairs"), reports.top_values(pairs, "service_name", 2)),
        (reports.top_pairings(counted("service_name", "primary_category"), 3, "n_pairs"), reports.top_pairings(pairs, 3)),
        (reports.monthly_counts(counted("requested_datetime"), weight="n_pairs"), reports.monthly_counts(pairs)),
        (
            reports.top_per_month(counted("service_name", "requested_datetime"), 2, weight="n_pairs"),
            reports.top_per_month(pairs, 2),
        ),
        (
            reports.zip_density(counted("zipcode_request", "has_id", "business_id"), request="has_id", weight="n_pairs"),
            reports.zip_density(pairs),
        ),
    ]
    for got, want in same:
        assert got.columns == want.columns
        assert rows(got, *got.columns) == rows(want, *want.columns) != []


def test_correlation_of_a_constant_is_not_a_number(spark):
    def found(data):
        return reports.density_correlation(spark.createDataFrame(data, "request_count long, business_count long")).first()[0]

    assert math.isnan(found([(1, 7), (2, 7), (3, 7)])) and math.isnan(found([(5, 1), (5, 2)]))
    assert found([(1, 7)]) is None and found([]) is None and found([(None, 1), (2, 2)]) is None
    assert found([(1, 2), (2, 4), (3, 6), (None, 9)]) == pytest.approx(1.0)


def test_counting_makes_no_pairs(spark):
    requests = request_table(spark, [(i, "x", 40.0, -75.0) for i in range(3_000)])
    businesses = business_table(spark, [(i, "Pets", 40.0, -75.0) for i in range(2_000)])
    counted = match_pairs(requests, businesses, default_affinity(spark), counted_by=["service_name"])
    assert counted.agg(F.sum("n_pairs"), F.count("*")).first() == (6_000_000, 1)
    with pytest.raises(ValueError, match="no_such"):
        match_pairs(requests, businesses, default_affinity(spark), counted_by=["no_such"])


@pytest.mark.parametrize("most", [1_000, 4_000_000])
def test_counts_of_a_dense_cell_are_held_once(monkeypatch, most):
    """However many blocks a cell is compared in, no more counts are kept than twice those of its groups."""
    monkeypatch.setattr(pair_counts_module, "CHUNK", 30_000)
    monkeypatch.setattr(pair_counts_module, "MAX_TOTALS", most, raising=False)
    rng = np.random.default_rng(5)

    def side(n, groups, name):
        lat, lon = np.radians(40 + rng.random(n) * 0.008), np.radians(-75 + rng.random(n) * 0.01)
        xyz = [np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)]
        of = np.arange(n) % groups
        columns = {"_key": [str(g) for g in of], f"_{name}_lat": np.degrees(lat), f"_{name}_lon": np.degrees(lon), "cy": np.zeros(n, int), "cx": np.zeros(n, int)}
        return pa.table({**columns, **dict(zip(("_x", "_y", "_z"), xyz)), name: of}), np.stack(xyz, axis=1), of

    (left, q, of_q), (right, b, of_b) = side(4_000, 20, "left"), side(300, 300, "right")
    held, totals = [], pair_counts_module._Count.totals
    monkeypatch.setattr(pair_counts_module._Count, "totals", lambda self: held.append(sum(map(len, self.codes))) or totals(self))
    schema = pa.schema([("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64()), *[(at, pa.float64()) for at in pair_counts_module._AT]])
    found = pair_counts_module._count_task(left, right, 250.0, ["left"], ["right"], schema)
    inside = np.sqrt(((q[:, None] - b) ** 2).sum(axis=2)) <= pair_counts_module.chord(250.0)
    want = np.zeros((20, 300), int)
    np.add.at(want, (np.broadcast_to(of_q[:, None], inside.shape)[inside], np.broadcast_to(of_b, inside.shape)[inside]), 1)
    got = np.zeros((20, 300), int)
    np.add.at(got, (found["left"].to_numpy(), found["right"].to_numpy()), found["n"].to_numpy())
    assert (got == want).all() and want.any()
    assert max(held) <= 3 * (want > 0).sum()
