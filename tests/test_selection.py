"""Order statistics by counting ranges, and rows in file order."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from streetloom.operators import reports
from streetloom.operators.selection import exact_median
from streetloom.operators.sentiment import sentiment_summary
from streetloom.session import scratch_path
from streetloom.sources import in_file_order, write_parquet


@pytest.mark.parametrize("ranges", [2, 7, 4_096])
@pytest.mark.parametrize(
    "values",
    [
        [5],
        [1, 2],
        [-3, -3, -3, 9],
        [None, 4, None],
        [0, 2**63 - 1, -(2**63)],
        [2**63 - 1, 2**63 - 2],
        [random.Random(1).randrange(-(10**6), 10**6) for _ in range(301)],
        [7] * 50 + list(range(40)),
    ],
)
def test_median_equals_sorting(spark, values, ranges):
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    assert exact_median(frame, "v", ranges) == statistics.median(v for v in values if v is not None)


def test_median_without_values(spark):
    assert exact_median(spark.createDataFrame([(None,)], "v long"), "v") is None
    assert exact_median(spark.createDataFrame([], "v long"), "v") is None


def test_median_of_a_million_different_counts(spark):
    frame = spark.range(1_000_000).select((F.col("id") * 7_919 % 1_000_003).alias("v")).cache()
    assert frame.select("v").distinct().count() == 1_000_000
    want = sorted(k * 7_919 % 1_000_003 for k in range(1_000_000))[499_999:500_001]
    assert exact_median(frame, "v") == sum(want) / 2
    frame.unpersist()


def test_summary_keeps_no_buffer_of_counts(spark):
    rollup = spark.createDataFrame([(0.5, 3), (-0.25, 10), (0.1, 4)], "avg_sentiment double, review_count long")
    found = sentiment_summary(rollup)
    assert found.first().median_review_count == 4.0 and found.first().median_avg_sentiment == 0.1
    assert sentiment_summary(rollup.where("false")).first().median_review_count is None


def test_sorted_parquet_is_in_order_over_its_files(spark):
    path = scratch_path(spark, "sorted")
    rng = random.Random(2)
    data = [(rng.randrange(10**6), k) for k in range(5_000)]
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "300")
    try:
        write_parquet(spark.createDataFrame(data, "key int, value int").repartition(7), path, order_by=["key", "value"])
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    got = sorted(tuple(r) for r in in_file_order(spark, path, "place").select("place", "key", "value").collect())
    assert got == [(n + 1, *row) for n, row in enumerate(sorted(data))]


def test_every_row_has_a_group(spark):
    rows = spark.createDataFrame([("A", 1), ("b", 2), (None, 3), ("zoo", 4)], "service_name string, id int")
    groups = spark.createDataFrame([("a", "first"), ("b", "second")], "service_name string, request_group string")
    named = reports.with_group(rows, groups)
    assert {r.id: r.request_group for r in named.collect()} == {1: "first", 2: "second", 3: "ungrouped", 4: "ungrouped"}
    assert named.columns == ["service_name", "id", "request_group"]
