"""Closest matches with their ranks, found without making all pairs, equal those picked among all ranked pairs."""

import random

import numpy as np
import pytest

from streetloom.operators import nearest
from streetloom.operators.matching import closest_match
from streetloom.plans.integration import match_pairs

REQUESTS = (
    "service_request_id bigint, service_name string, subject string, agency_responsible string, requested_datetime string,"
    " address string, zipcode string, lat double, lon double"
)
BUSINESSES = (
    "business_id string, name string, address string, postal_code string, latitude double, longitude double, stars double,"
    " review_count bigint, primary_category string, categories_normalized array<string>"
)
AFFINITY = [("pothole", "bars", 0.31), ("pothole", "shops", 0.8), ("noise", "bars", 0.95), ("Noise", "shops", 0.7), ("trash", "shops", 0.31)]


def _tables(spark, seed, n_requests=300, n_businesses=400, steps=40):
    draw = random.Random(seed)

    def place():  # few places, about 20 m apart: many are shared, and many distances are equal
        lat = draw.choice([None, float("nan")]) if draw.random() < 0.02 else 39.95 + draw.randrange(steps) * 2e-4
        return lat, -75.1 + draw.randrange(steps) * 2.5e-4

    requests = [
        (i if i % 50 else None if i % 100 else 7, draw.choice(["pothole", "Noise", "trash", "NOISE", "other", None]), *["x"] * 5, *place())
        for i in range(n_requests)
    ]
    businesses = [
        (None if i == 3 else f"b{i:04}", "n", "a", "z", *place(), 1.0, 2, draw.choice(["bars", "shops", "else", None]), ["c"])
        for i in range(n_businesses)
    ]
    affinity = spark.createDataFrame(AFFINITY, "service_name string, category string, score double")
    return spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(businesses, BUSINESSES), affinity


def _rows(pairs):
    columns = ["service_request_id", "business_id", "distance_m", "proximity_score", "category_similarity", "hybrid_score", "match_rank"]
    return sorted(map(tuple, closest_match(pairs).select(columns).collect()), key=repr)


@pytest.mark.parametrize("seed, weights", [(1, (0.5, 0.5)), (2, (0.0, 1.0)), (3, (0.9, -0.2))])
def test_nearest_equals_the_pick_among_all_pairs(spark, seed, weights):
    tables = _tables(spark, seed)
    near = match_pairs(*tables, 250, *weights, nearest=True)
    every = match_pairs(*tables, 250, *weights)
    assert near.count() < every.count() / 2
    found = _rows(near)
    assert found == _rows(every) and len(found) > 250


def test_parts_blocks_and_chunks_lose_nothing(spark, monkeypatch):
    tables = _tables(spark, 4)
    expected = _rows(match_pairs(*tables))
    for name, value in (("LEFT_ROWS", 20), ("CANDIDATES", 500), ("BLOCK_ROWS", 2), ("CHUNK", 300)):
        monkeypatch.setattr(nearest, name, value)
    assert _rows(match_pairs(*tables, nearest=True)) == expected


def test_tables_it_cannot_take_go_to_the_join(spark):
    requests, businesses, affinity = _tables(spark, 5, 60, 60)
    twice = affinity.unionByName(affinity)
    assert nearest.plain_scores(twice) is None and nearest.plain_scores(affinity)["noise", "bars"] == 0.95
    assert _rows(match_pairs(requests, businesses, twice, nearest=True)) == _rows(match_pairs(requests, businesses, twice))
    asked = requests.select("service_request_id", "service_name", "lat", "lon")
    by = ("service_request_id", "business_id", "service_name", "primary_category")
    assert nearest.nearest_ranked(asked, businesses, {}, *by, right_rows=5) is None
    assert nearest.nearest_ranked(asked, businesses, {}, *by, radius_m=50_000) is None


def test_empty_tables(spark):
    requests, businesses, affinity = _tables(spark, 6, 20, 20)
    assert _rows(match_pairs(requests.limit(0), businesses, affinity, nearest=True)) == []
    assert _rows(match_pairs(requests, businesses.limit(0), affinity, nearest=True)) == []
    assert _rows(match_pairs(requests, businesses, affinity.limit(0), nearest=True)) == _rows(match_pairs(requests, businesses, affinity.limit(0)))


def test_closest_queries_make_no_pairs(spark, monkeypatch):
    """Rows that reach the last step: one for each request, and the pairs of those left open."""
    from catalog import queries

    requests, businesses, affinity = _tables(spark, 7, 300, 300, steps=1000)  # hardly any equal places
    once = requests.where("service_request_id % 50 != 0").withColumn("lat", requests.lat * 1e-3 + 39.91)
    roles = {"requests": once, "businesses": businesses.withColumn("latitude", businesses.latitude * 1e-3 + 39.91)}
    monkeypatch.setattr(queries, "role", lambda spark, sf_dir, name: roles[name])
    monkeypatch.setattr(queries, "_affinity", lambda spark: affinity)
    seen = []
    monkeypatch.setattr(queries.matching, "closest_match", lambda near: seen.append(near.count()) or closest_match(near))
    n = queries.QUERIES["closest_match"](spark, "").count()
    every = match_pairs(once, roles["businesses"], affinity).count()
    assert n > 100 and n <= seen[0] < 1.5 * n < every / 2


def _best_rows(pairs):
    columns = [
        "service_request_id", "business_id", "distance_m", "proximity_score", "category_similarity", "hybrid_score", "match_rank",
        "service_name", "business_name", "primary_category",
    ]
    return sorted(map(tuple, pairs.where("match_rank = 1").select(columns).collect()), key=repr)


@pytest.mark.parametrize("seed, weights, radius", [(1, (0.5, 0.5), 250), (2, (0.0, 1.0), 250), (3, (0.9, -0.2), 60), (4, (-0.5, 0.5), 250), (5, (1.0, 0.0), 900)])
def test_best_equals_the_first_ranked_of_all_pairs(spark, monkeypatch, seed, weights, radius):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 4)
    tables = _tables(spark, seed)
    best, every = match_pairs(*tables, radius, *weights, best=True), match_pairs(*tables, radius, *weights)
    found = _best_rows(best)
    assert found == _best_rows(every) and len(found) > 150


def test_best_matches_makes_no_pairs(spark, monkeypatch):
    from catalog import queries

    requests, businesses, affinity = _tables(spark, 7, 300, 300, steps=1000)
    once = requests.where("service_request_id % 50 != 0").withColumn("lat", requests.lat * 1e-3 + 39.91)
    roles = {"requests": once, "businesses": businesses.withColumn("latitude", businesses.latitude * 1e-3 + 39.91)}
    monkeypatch.setattr(queries, "role", lambda spark, sf_dir, name: roles[name])
    monkeypatch.setattr(queries, "_affinity", lambda spark: affinity)
    seen, best_matches = [], queries.matching.best_matches
    monkeypatch.setattr(queries.matching, "best_matches", lambda ranked, k: seen.append(ranked.count()) or best_matches(ranked, k))
    found = queries.QUERIES["best_matches"](spark, "").collect()
    every = match_pairs(once, roles["businesses"], affinity)
    assert found == best_matches(every, 5).collect() and len(found) == 5
    assert seen[0] < every.count() / 2


def test_rows_that_cannot_be_best_are_left_out():
    by = nearest._Scoring({("a", "x"): 1.0, ("a", "y"): 0.3}, 250.0, 0.5, 0.5)
    away = np.array([2.0, 3.0, 40.0, 249.0]) / nearest.EARTH_RADIUS_M
    kept = nearest._may_be_best(np.array([0]), np.array([1, 0, 0, 0]), away, 1.0 / nearest.EARTH_RADIUS_M, by)
    assert kept.tolist() == [False, True, False, False]
