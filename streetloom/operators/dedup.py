"""De-duplication with a stated order in place of file order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetloom.fixed_values import EVENT_PLACES
from streetloom.functions.rounding import half_even


def keep_first(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``order_by`` (end it with a unique column); null keys form one group.

    ``row_number = 1`` is planned with a group limit on both sides of the exchange, so each map task
    sends at most one row per key: a key with a third of all rows still reaches its reducer as one
    row per map task.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def order_by_content(df: DataFrame) -> list[Column]:
    """Order for inputs that have no column to order by: it depends on the rows' values only.

    Rows that tie are equal in all but map columns.
    """
    return [F.xxhash64(*[F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind])]


def keep_first_event(
    df: DataFrame,
    order_by: Sequence[str | Column],
    kind: str = "service_name",
    at: str = "requested_datetime",
    lat: str = "lat",
    lon: str = "lon",
    places: int = EVENT_PLACES,
) -> DataFrame:
    """First report of the same kind at the same rounded place on the same day."""
    day = F.to_date(F.col(at).try_cast("timestamp_ntz"))
    keys = [F.col(kind), half_even(F.col(lat), places), half_even(F.col(lon), places), day]
    return keep_first(df, keys, order_by)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows whose key occurs more than once, and how many keys that are."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count("*").alias("duplicate_keys"),
    )
