"""The whole work from raw files to the integrated table, one stored table per step.

Each step reads its inputs, writes one Parquet table and returns it read back, so later steps start from
storage and none repeats the work of another. Run them in this order: businesses, reviews, sentiment,
requests, integration.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom import schemas
from streetloom.dimensions import default_affinity, default_lexicon
from streetloom.fixed_values import CAT_WEIGHT, GEO_WEIGHT, RADIUS_M, ZIP_PREFIX
from streetloom.operators.columns import filter_zip_prefix
from streetloom.operators.matching import closest_match
from streetloom.operators.sentiment import lexicon_sentiment, sentiment_by_business
from streetloom.plans.businesses import clean_businesses
from streetloom.plans.integration import match_pairs
from streetloom.plans.requests import clean_requests
from streetloom.plans.reviews import clean_reviews, reviews_of
from streetloom.sources import (
    read_csv_positional,
    read_jsonl,
    read_parquet,
    write_by_radius,
    write_parquet,
)


def _stored(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path)


def store_businesses(
    spark: SparkSession,
    source: str,
    target: str,
    taxonomy: Mapping[str, Sequence[str]] | DataFrame,
    zip_prefix: str = ZIP_PREFIX,
    match: str = "substring",
) -> DataFrame:
    """JSON lines of all businesses → cleaned businesses of the ZIP area; taxonomy and match as in ``clean_businesses``."""
    raw = filter_zip_prefix(read_jsonl(spark, source, schemas.BUSINESS_RAW), "postal_code", zip_prefix)
    return _stored(clean_businesses(raw, taxonomy, match=match), target)


def store_reviews(spark: SparkSession, source: str, businesses: DataFrame, target: str) -> DataFrame:
    """JSON lines of all reviews → cleaned reviews of the given businesses."""
    raw = read_jsonl(spark, source, schemas.REVIEW_RAW)
    return _stored(clean_reviews(reviews_of(raw, businesses)), target)


def store_sentiment(reviews: DataFrame, target: str, lexicon: DataFrame | None = None) -> DataFrame:
    """Cleaned reviews → sentiment per business."""
    words = default_lexicon(reviews.sparkSession) if lexicon is None else lexicon
    return _stored(sentiment_by_business(lexicon_sentiment(reviews, words)), target)


def store_requests(spark: SparkSession, source: str, target: str, labels_first: bool = False) -> DataFrame:
    """Directory of request CSV files → cleaned requests."""
    raw = read_csv_positional(spark, source)
    return _stored(clean_requests(raw, labels_first=labels_first), target)


def store_matches(
    requests: DataFrame,
    businesses: DataFrame,
    pairs_target: str,
    closest_target: str,
    affinity: DataFrame | None = None,
    radius_m: float = RADIUS_M,
    geo_weight: float = GEO_WEIGHT,
    cat_weight: float = CAT_WEIGHT,
) -> tuple[DataFrame, DataFrame]:
    """Integrated table and its closest matches, each in a folder of its radius beside other radii."""
    spark = requests.sparkSession
    scores = default_affinity(spark) if affinity is None else affinity
    write_by_radius(
        match_pairs(requests, businesses, scores, radius_m, geo_weight, cat_weight), pairs_target, radius_m
    )
    of_radius = F.col("radius_m") == int(radius_m)
    pairs = read_parquet(spark, pairs_target).where(of_radius)
    write_by_radius(closest_match(pairs.drop("radius_m")), closest_target, radius_m)
    return pairs, read_parquet(spark, closest_target).where(of_radius)
