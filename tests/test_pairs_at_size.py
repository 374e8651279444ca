"""Queries over all pairs exchange no pairs, nor as much as there are pairs."""

import statistics

import pytest
from pyspark.sql import functions as F

from streetloom.operators.matching import match_summary
from streetloom.operators.radius import radius_join
from streetloom.operators.sentiment import with_sentiment

PAIRS = "service_request_id bigint, business_id bigint, hybrid_score double, distance_m double, match_rank int"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 7, 500])
def test_match_summary_equals_plain_statistics(spark, n):
    rows = [(i // 5, (i * 7) % 13 or None, (i * 31 % 101) / 100, (i * i * 37 % 2501) / 10, i % 5 + 1) for i in range(n)]
    found = match_summary(spark.createDataFrame(rows, PAIRS)).first()
    hybrid, distance = [r[2] for r in rows], [r[3] for r in rows]
    assert (found.pairs, found.requests) == (n, sum(r[4] == 1 for r in rows))
    assert found.businesses == len({r[1] for r in rows} - {None})
    assert (found.min_hybrid, found.max_hybrid, found.min_distance_m, found.max_distance_m) == (
        min(hybrid), max(hybrid), min(distance), max(distance),
    )
    assert found.avg_hybrid == pytest.approx(statistics.fmean(hybrid)) and found.avg_distance_m == pytest.approx(statistics.fmean(distance))
    assert found.median_distance_m == pytest.approx(statistics.median(distance))
    assert found.pairs_per_request == found.pairs / found.requests


def test_match_summary_keeps_no_distances_by_business(spark):
    pairs = spark.range(1000).selectExpr(
        "id % 50 as service_request_id", "id % 90 as business_id", "0.5D as hybrid_score", "cast(id as double) as distance_m",
        "1 as match_rank",
    )
    by_business = [line for line in _plan(match_summary(pairs)).splitlines() if "keys=[business_id" in line]
    assert by_business and not [line for line in by_business if "median" in line or "percentile" in line]


def test_with_sentiment_moves_the_rollup_to_the_pairs(spark):
    pairs = spark.range(40).select(F.col("id").alias("service_request_id"), (F.col("id") % 4).alias("business_id"))
    rollup = spark.createDataFrame([(0, 0.5, 3), (1, -0.25, 2)], "business_id bigint, avg_sentiment double, review_count bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = with_sentiment(pairs, rollup)
        assert "SortMergeJoin" not in _plan(joined) and "Exchange hashpartitioning" not in _plan(joined)
        expected = sorted((i, {0: 0.5, 1: -0.25}.get(i % 4), {0: 3, 1: 2}.get(i % 4)) for i in range(40))
        for found in (joined, with_sentiment(pairs, rollup, max_broadcast=1)):
            rows = found.select("service_request_id", "avg_sentiment", "sentiment_reviews").collect()
            assert sorted(map(tuple, rows), key=lambda r: r[0]) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_radius_join_sends_no_points_on_the_sphere(spark):
    left = spark.range(50).selectExpr("id as l", "39.9D + id / 1e3D as lat", "-75.2D as lon")
    right = spark.range(20).selectExpr("id as r", "39.9D + id / 1e3D as latitude", "-75.2D as longitude")
    joined = radius_join(left, right)
    below, sent = None, []
    for line in _plan(joined).splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        below = below if below is not None and depth > below else depth if "Exchange hashpartitioning(cy" in line else None
        sent += [line] if below is not None else []
    assert sent and not [line for line in sent if "_lx" in line or "_rx" in line]
    assert {(row.l, row.r) for row in joined.collect()} == {(a, b) for a in range(50) for b in range(20) if abs(a - b) <= 2}
