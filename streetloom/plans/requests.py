"""Cleaning of service requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.fixed_values import EVENT_PLACES
from streetloom.functions.labels import normalize_label, zip_from_text
from streetloom.functions.rounding import half_even
from streetloom.operators.columns import drop_columns, drop_missing
from streetloom.operators.dedup import keep_first, keep_first_event


def complete_requests(df: DataFrame) -> DataFrame:
    """Requests with coordinates, a type and at least one of subject and notes."""
    return drop_missing(df, all_of=["lat", "lon", "service_name"], any_of=["subject", "status_notes"])


def normalize_requests(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "service_name": normalize_label(F.col("service_name")),
            "subject": normalize_label(F.col("subject")),
            "zipcode": zip_from_text(F.col("zipcode")),
        }
    )


def clean_requests(
    raw: DataFrame, order_by: Sequence[str] = ("objectid",), labels_first: bool = False
) -> DataFrame:
    """Raw requests → complete, distinct, normalised ones, without the unused columns.

    The first row of each request id and then of each event (same type, place and day) stays, in
    ``order_by``. Labels are normalised after de-duplication unless ``labels_first``.
    """
    complete = complete_requests(drop_columns(raw))
    if labels_first:
        complete = normalize_requests(complete)
    once = keep_first(complete, ["service_request_id"], order_by)
    events = keep_first_event(once, order_by)
    return events if labels_first else normalize_requests(events)


def request_counts(raw: DataFrame, order_by: Sequence[str] = ("objectid",)) -> DataFrame:
    """One row: requests read, complete, with distinct id, as distinct events, and without a valid ZIP.

    One scan: rows collapse per request id, the ids per event, and each level carries the sums of the
    level below, so no stage is counted by running the chain again.
    """
    complete = (
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("service_name").isNotNull()
        & (F.col("subject").isNotNull() | F.col("status_notes").isNotNull())
    )
    event = F.struct(
        F.col("service_name").alias("kind"),
        half_even(F.col("lat"), EVENT_PLACES).alias("lat"),
        half_even(F.col("lon"), EVENT_PLACES).alias("lon"),
        F.to_date(F.col("requested_datetime").try_cast("timestamp_ntz")).alias("day"),
        zip_from_text(F.col("zipcode")).isNull().alias("no_zip"),
    )
    order = F.struct(*order_by)
    by_id = (
        raw.withColumn("_complete", complete)
        .groupBy("service_request_id")
        .agg(
            F.count("*").alias("read"),
            F.count_if("_complete").alias("complete"),
            F.min_by(event, F.when(F.col("_complete"), order)).alias("event"),
            F.min(F.when(F.col("_complete"), order)).alias("first"),
        )
    )
    by_event = by_id.groupBy("event.kind", "event.lat", "event.lon", "event.day").agg(
        F.sum("read").alias("read"),
        F.sum("complete").alias("complete"),
        F.count("first").alias("ids"),
        F.min_by("event.no_zip", "first").alias("no_zip"),
    )
    return by_event.agg(
        F.sum("read").alias("read"),
        F.sum("complete").alias("complete"),
        F.sum("ids").alias("distinct_ids"),
        F.count_if(F.col("ids") > 0).alias("distinct_events"),
        F.count_if((F.col("ids") > 0) & F.col("no_zip")).alias("without_zip"),
    )
