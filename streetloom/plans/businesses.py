"""Cleaning of businesses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.fixed_values import FUZZY_THRESHOLD, UNCATEGORIZED
from streetloom.functions.labels import name_key, zip_from_digits
from streetloom.operators.columns import flag_valid_coordinates, snake_case_columns
from streetloom.operators.dedup import keep_first, order_by_content
from streetloom.operators.fuzzy import fuzzy_dedup
from streetloom.operators.taxonomy import categorize, categorize_by_table
from streetloom.schemas import BUSINESS_CLEAN
from streetloom.session import checkpointed


def clean_location(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Flag coordinates and bring postal codes to five digits."""
    flagged = flag_valid_coordinates(df, lat, lon)
    return flagged.withColumn("postal_code", zip_from_digits(F.col("postal_code")))


def most_reviewed_first(key: str = "business_id") -> list[Column]:
    """Order of duplicates: more reviews first, missing counts last, then the key."""
    return [F.coalesce(-F.col("review_count"), F.lit(1)), F.col(key)]


def drop_similar_businesses(df: DataFrame, threshold: int = FUZZY_THRESHOLD) -> DataFrame:
    """Of businesses with equal name and similar address keep the most reviewed one."""
    return fuzzy_dedup(
        df, name_key(F.col("name")), F.lower("address"), most_reviewed_first(), threshold
    )


def located_once(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """First row per id among the businesses with valid coordinates, categories filled.

    Without ``order_by`` copies of an id are ordered by their content.
    """
    located = (
        snake_case_columns(raw)
        .transform(clean_location)
        .where("valid_coordinates")
        .na.fill(UNCATEGORIZED, subset=["categories"])
    )
    return keep_first(located, ["business_id"], order_by or order_by_content(located))


def clean_businesses(
    raw: DataFrame,
    taxonomy: Mapping[str, Sequence[str]] | DataFrame,
    order_by: Sequence[str] | None = None,
    threshold: int = FUZZY_THRESHOLD,
    match: str = "substring",
) -> DataFrame:
    """Raw businesses → located, distinct ones with taxonomy categories.

    A mapping becomes part of the row expression, a DataFrame (``schemas.TAXONOMY``) of any size is joined. There is no
    default, as scores depend on the whole list: ``dimensions.STARTER_TAXONOMY`` has only the most frequent keywords.
    """
    # stored, as the similarity step reads the rows several times
    distinct = drop_similar_businesses(checkpointed(located_once(raw, order_by)), threshold)
    if isinstance(taxonomy, DataFrame):
        named = categorize_by_table(distinct, "business_id", taxonomy, match=match)
    else:
        named = categorize(distinct, taxonomy, match=match)
    return named.select(*BUSINESS_CLEAN)


def business_counts(
    raw: DataFrame, order_by: Sequence[str] | None = None, threshold: int = FUZZY_THRESHOLD
) -> DataFrame:
    """One row: businesses read, located, with distinct id, and left after dropping similar ones."""
    flagged = clean_location(snake_case_columns(raw))
    by_id = flagged.groupBy("business_id").agg(
        F.count("*").alias("read"), F.count_if("valid_coordinates").alias("located")
    )
    shops = drop_similar_businesses(checkpointed(located_once(raw, order_by)), threshold)
    return by_id.agg(
        F.sum("read").alias("read"),
        F.sum("located").alias("located"),
        F.count_if(F.col("located") > 0).alias("distinct_ids"),
    ).withColumn("distinct_shops", shops.agg(F.count("*")).scalar())


def location_counts(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """One row: rows, latitudes and longitudes missing or impossible, coordinates outside the box, bad ZIPs."""
    y, x = F.col(lat), F.col(lon)
    bad_lat = F.coalesce(~y.between(-90, 90) | F.isnan(y), F.lit(True))
    bad_lon = F.coalesce(~x.between(-180, 180) | F.isnan(x), F.lit(True))
    flagged = clean_location(df, lat, lon)
    return flagged.agg(
        F.count("*").alias("businesses"),
        F.count_if(bad_lat).alias("invalid_latitude"),
        F.count_if(bad_lon).alias("invalid_longitude"),
        F.count_if(~bad_lat & ~bad_lon & ~F.col("valid_coordinates")).alias("outside_box"),
        F.count_if("valid_coordinates").alias("valid_coordinates"),
        F.count_if(F.col("postal_code").isNull()).alias("missing_zip"),
    )
