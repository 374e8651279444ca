"""Column-level steps on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.fixed_values import LAT_BOUNDS, LON_BOUNDS, REQUEST_DROPPED, ZIP_PREFIX
from streetloom.functions.geo import within_bounds
from streetloom.functions.labels import has_zip_prefix, snake_case


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = [snake_case(name) for name in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalisation: {names}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, columns: Sequence[str] = REQUEST_DROPPED) -> DataFrame:
    return df.drop(*columns)


def flag_valid_coordinates(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    lat_bounds: tuple = LAT_BOUNDS,
    lon_bounds: tuple = LON_BOUNDS,
) -> DataFrame:
    flag = within_bounds(F.col(lat), F.col(lon), lat_bounds, lon_bounds)
    return df.withColumn("valid_coordinates", flag)


def filter_zip_prefix(df: DataFrame, column: str = "postal_code", prefix: str = ZIP_PREFIX) -> DataFrame:
    return df.where(has_zip_prefix(F.col(column), prefix))


def drop_missing(df: DataFrame, all_of: Sequence[str] = (), any_of: Sequence[str] = ()) -> DataFrame:
    """Keep rows that have every column of ``all_of`` and at least one of ``any_of``."""
    if all_of:
        df = df.na.drop("any", subset=list(all_of))
    if any_of:
        df = df.na.drop("all", subset=list(any_of))
    return df
