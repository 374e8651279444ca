"""Explicit schemas: ZIPs and identifiers stay text, nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from streetloom.fixed_values import REQUEST_COLUMNS

_REQUEST_TYPES = {
    "objectid": T.LongType(),
    "service_request_id": T.LongType(),
    "lat": T.DoubleType(),
    "lon": T.DoubleType(),
}

REQUESTS_RAW = T.StructType(
    [T.StructField(name, _REQUEST_TYPES.get(name, T.StringType())) for name in REQUEST_COLUMNS]
)

BUSINESS_RAW = T.StructType(
    [
        T.StructField("business_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("review_count", T.LongType()),
        T.StructField("is_open", T.IntegerType()),
        T.StructField("categories", T.StringType()),
        T.StructField("hours", T.MapType(T.StringType(), T.StringType())),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

BUSINESS_CLEAN = (
    "business_id", "name", "address", "city", "state", "postal_code",
    "latitude", "longitude", "stars", "review_count", "is_open",
    "primary_category", "categories_normalized",
)

REVIEW_RAW = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("useful", T.LongType()),
    ]
)

REVIEW_CLEAN = ("review_id", "business_id", "stars", "date", "useful", "text", "text_clean")

AFFINITY = T.StructType(
    [
        T.StructField("service_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)

REQUEST_GROUPS = T.StructType(
    [
        T.StructField("service_name", T.StringType()),
        T.StructField("request_group", T.StringType()),
    ]
)

TAXONOMY = T.StructType(
    [
        T.StructField("category_group", T.StringType()),
        T.StructField("keyword", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
    ]
)

LEXICON = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("valence", T.DoubleType()),
        T.StructField("kind", T.StringType()),
    ]
)
