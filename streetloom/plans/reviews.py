"""Selection and cleaning of reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.functions.text import clean_text
from streetloom.operators.columns import drop_missing, snake_case_columns
from streetloom.operators.dedup import keep_first, order_by_content
from streetloom.schemas import REVIEW_CLEAN, REVIEW_RAW


def reviews_of(reviews: DataFrame, businesses: DataFrame, key: str = "business_id") -> DataFrame:
    """Reviews whose business is in the business table; only the fields used later."""
    ids = businesses.select(key)
    return reviews.select(*REVIEW_RAW.names).join(ids, key, "left_semi").select(*REVIEW_RAW.names)


def retention(reviews: DataFrame, businesses: DataFrame, key: str = "business_id") -> DataFrame:
    """One row: reviews read, kept and the percentage kept."""
    per_business = reviews.groupBy(key).agg(F.count("*").alias("n"))
    ids = businesses.select(key).distinct().withColumn("_known", F.lit(True))
    return (
        per_business.join(ids, key, "left")
        .agg(
            F.sum("n").alias("total"),
            F.coalesce(F.sum(F.when(F.col("_known"), F.col("n"))), F.lit(0)).cast("long").alias("kept"),
        )
        .withColumn("pct_kept", F.round(100 * F.col("kept") / F.col("total"), 1))
    )


def clean_reviews(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Raw reviews → complete, distinct ones with cleaned, non-empty text.

    The first row of each review id, and of each text of a business, stays in ``order_by``; without it the
    earliest date comes first, then the review id, then the content.
    """
    complete = drop_missing(snake_case_columns(raw), all_of=["text", "business_id", "date"])
    order_by = order_by or ["date", "review_id", *order_by_content(complete)]
    once = keep_first(complete, ["review_id"], order_by)
    distinct = keep_first(once, ["business_id", F.sha2("text", 256)], order_by)  # no text is sorted or shipped as a key
    cleaned = distinct.withColumn("text_clean", clean_text(F.col("text"))).where("text_clean <> ''")
    return cleaned.select(*REVIEW_CLEAN)


def review_counts(raw: DataFrame, order_by: Sequence[str] = ("review_id",)) -> DataFrame:
    """One row: reviews read, complete, with distinct id, with distinct text per business, and with words left.

    One scan: rows collapse per review id, ids per text (by digest), and sums are carried along.
    """
    columns = snake_case_columns(raw)
    order = F.struct(*order_by)
    first = F.when(
        F.col("text").isNotNull() & F.col("business_id").isNotNull() & F.col("date").isNotNull(), order
    )
    facts = F.struct(
        F.col("business_id").alias("business"),
        F.sha2("text", 256).alias("digest"),
        (clean_text(F.col("text")) != "").alias("words"),
    )
    by_id = columns.select("review_id", first.alias("first"), facts.alias("facts")).groupBy("review_id").agg(
        F.count("*").alias("read"),
        F.count("first").alias("complete"),
        F.min_by("facts", "first").alias("facts"),
    )
    by_text = by_id.groupBy("facts.business", "facts.digest").agg(
        F.sum("read").alias("read"),
        F.sum("complete").alias("complete"),
        F.count_if(F.col("complete") > 0).alias("ids"),
        F.max("facts.words").alias("words"),
    )
    return by_text.agg(
        F.sum("read").alias("read"),
        F.sum("complete").alias("complete"),
        F.sum("ids").alias("distinct_ids"),
        F.count_if(F.col("ids") > 0).alias("distinct_texts"),
        F.count_if((F.col("ids") > 0) & F.col("words")).alias("with_words"),
    )
