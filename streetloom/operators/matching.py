"""Scores, ranks and picks on request-business pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.fixed_values import CAT_WEIGHT, GEO_WEIGHT, RADIUS_M, UNKNOWN
from streetloom.functions.geo import hybrid_score, proximity_score
from streetloom.functions.rounding import half_even
from streetloom.operators.dedup import keep_first
from streetloom.operators.radius import CELL
from streetloom.operators.ranking import number_rows, number_rows_by_ranges

MEDIAN_TASKS_PER_CORE = 16


def with_affinity_key(df: DataFrame, affinity: DataFrame, kind: str = "service_name", key: str = "affinity_key") -> DataFrame:
    """Add ``key``, under which the affinity table has the row's kind: in lower case, or as written where the table
    has that writing and lacks the lower case."""
    known = affinity.select(F.col("service_name").alias("_raw")).distinct()
    written = known.join(known.withColumnRenamed("_raw", "_known"), F.lower("_raw") == F.col("_known"), "left_anti")
    joined = df.join(written, F.col(kind) == F.col("_raw"), "left")
    return joined.withColumn(key, F.coalesce("_raw", F.lower(kind))).drop("_raw")


def with_affinity(
    df: DataFrame,
    affinity: DataFrame,
    kind: str = "service_name",
    category: str = "primary_category",
    raw_keys: bool = False,
) -> DataFrame:
    """Add ``affinity``: score of (lower-cased kind, category), 0.0 where the table has none.

    ``affinity`` (service_name, category, score) has one row per pair. With ``raw_keys`` a kind that the
    table lacks in lower case is also looked up as written; rows that have an ``affinity_key`` are looked up by it alone.
    """
    if raw_keys and "affinity_key" not in df.columns:
        return with_affinity(with_affinity_key(df, affinity, kind), affinity, kind, category, True).drop("affinity_key")
    scores = affinity.select(
        F.col("service_name").alias("_kind"), F.col("category").alias("_category"), F.col("score").alias("_score")
    )
    key = F.col("affinity_key") if raw_keys else F.lower(F.col(kind))
    joined = df.join(scores, (key == F.col("_kind")) & (F.col(category) == F.col("_category")), "left")
    return joined.withColumn("affinity", F.coalesce("_score", F.lit(0.0))).drop("_kind", "_category", "_score")


def affinity_coverage(df: DataFrame, affinity: DataFrame, kind: str = "service_name") -> DataFrame:
    """One row: distinct kinds (null counts as ``unknown``) and how many of them the table scores."""
    kinds = df.select(F.coalesce(F.col(kind), F.lit(UNKNOWN)).alias("kind")).distinct()
    known = affinity.select(F.col("service_name").alias("known")).distinct()
    by_lower = known.withColumn("by_lower", F.lit(True))
    as_written = known.withColumnRenamed("known", "written").withColumn("by_writing", F.lit(True))
    return (
        kinds.join(by_lower, F.lower("kind") == F.col("known"), "left")
        .join(as_written, F.col("kind") == F.col("written"), "left")
        .agg(
            F.count("*").alias("kinds"),
            F.count_if(F.coalesce("by_lower", "by_writing", F.lit(False))).alias("kinds_scored"),
        )
    )


def score_pairs(
    pairs: DataFrame,
    affinity: DataFrame,
    radius_m: float = RADIUS_M,
    geo_weight: float = GEO_WEIGHT,
    cat_weight: float = CAT_WEIGHT,
) -> DataFrame:
    """Add distance_m, proximity_score, category_similarity and hybrid_score to radius-join pairs.

    Distance is rounded to 2 places, proximity comes from it and the hybrid score from the rounded parts,
    each with 4 places, halves to even. A request type that the affinity table lacks in lower case is looked up
    as written; pairs that carry an ``affinity_key`` save that step. Missing labels become ``unknown``. ``distance`` stays for ranking.
    """
    labelled = pairs.na.fill(UNKNOWN, subset=["service_name", "primary_category"])
    parts = (
        with_affinity(labelled, affinity, raw_keys=True)
        .withColumn("distance_m", half_even(F.col("distance"), 2))
        .withColumn("category_similarity", half_even(F.col("affinity"), 4))
        .drop("affinity", "affinity_key")
    )
    return with_hybrid(parts, radius_m, geo_weight, cat_weight)


def with_hybrid(pairs: DataFrame, radius_m: float, geo_weight: float, cat_weight: float) -> DataFrame:
    """Add proximity_score and hybrid_score, from distance_m and category_similarity."""
    hybrid = hybrid_score(F.col("proximity_score"), F.col("category_similarity"), geo_weight, cat_weight)
    near = half_even(proximity_score(F.col("distance_m"), radius_m), 4)
    return pairs.withColumn("proximity_score", near).withColumn("hybrid_score", half_even(hybrid, 4))


def rank_matches(scored: DataFrame, wide: str = "wide") -> DataFrame:
    """Add ``match_rank``: 1..n per request, best hybrid score first, then nearest, then business id.

    Pairs that carry the columns of their cell (``radius.CELL``, dropped here) are ranked where the join left them. If there
    is a flag column ``wide`` (dropped here), it marks requests with matches in several cells or with more than one
    task should sort; those are ranked over ranges. The flag is known before the join, so no pair is made for both.
    """
    order = [F.desc("hybrid_score"), F.asc("distance"), F.asc("business_id")]
    cell = [name for name in CELL if name in scored.columns]
    by = [*cell, "service_request_id"]
    if wide not in scored.columns:
        return number_rows(scored, by, order, "match_rank").drop(*cell)
    narrow = scored.where(~F.col(wide)).drop(wide)
    broad = scored.where(F.col(wide)).drop(wide, *cell)
    return number_rows(narrow, by, order, "match_rank").drop(*cell).unionByName(
        number_rows_by_ranges(broad, "service_request_id", order, "match_rank")
    )


def closest_match(ranked: DataFrame) -> DataFrame:
    """The nearest business of each request; equal distances go to the better score, then the better rank."""
    return keep_first(
        ranked, ["service_request_id"], [F.asc("distance_m"), F.desc("hybrid_score"), F.asc("match_rank")]
    )


def best_matches(ranked: DataFrame, k: int = 5) -> DataFrame:
    """The k rank-1 pairs with the highest hybrid score."""
    return (
        ranked.where(F.col("match_rank") == 1)
        .orderBy(F.desc("hybrid_score"), "service_request_id")
        .limit(k)
        .select("service_request_id", "service_name", "business_name", "primary_category", "distance_m", "hybrid_score")
    )


def match_summary(ranked: DataFrame) -> DataFrame:
    """One row of score and distance ranges and of the fan-out.

    Pairs are collapsed where they lie, first by business, which comes in few tasks, then by distance for the exact median:
    distances are rounded to 2 places, so there are at most 100 * radius + 1 different ones, and few tasks send them. The
    median is a pass of its own, as its counts in the groups of the first would be as many as the pairs.
    """
    by_business = ranked.groupBy("business_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("match_rank") == 1).alias("first"),
        *[
            how(name).alias(f"{label}_{name}")
            for name in ("hybrid_score", "distance_m")
            for label, how in (("min", F.min), ("max", F.max), ("sum", F.sum), ("n", F.count))
        ],
    )
    tasks = MEDIAN_TASKS_PER_CORE * ranked.sparkSession.sparkContext.defaultParallelism
    distances = ranked.select("distance_m").coalesce(tasks).groupBy("distance_m").agg(F.count("*").alias("n"))
    median = distances.agg(F.percentile("distance_m", 0.5, F.col("n")).alias("median_distance_m"))

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))

    return (
        by_business.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"),
            F.coalesce(F.sum("first"), F.lit(0)).alias("requests"),
            F.count("business_id").alias("businesses"),
            F.min("min_hybrid_score").alias("min_hybrid"),
            F.max("max_hybrid_score").alias("max_hybrid"),
            mean("hybrid_score").alias("avg_hybrid"),
            F.min("min_distance_m").alias("min_distance_m"),
            F.max("max_distance_m").alias("max_distance_m"),
            mean("distance_m").alias("avg_distance_m"),
        )
        .withColumn("median_distance_m", median.scalar())
        .withColumn("pairs_per_request", F.col("pairs") / F.col("requests"))
    )


def closest_summary(closest: DataFrame) -> DataFrame:
    """One row: mean and median distance to the nearest business."""
    return closest.agg(
        F.count("*").alias("requests"),
        F.avg("distance_m").alias("avg_nearest_m"),
        F.median("distance_m").alias("median_nearest_m"),
    )
