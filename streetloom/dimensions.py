"""Small tables that parametrise the jobs: affinity, request groups, taxonomy, lexicon."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streetloom import fixed_values, schemas


def inline_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """Rows held in the plan itself, so Catalyst knows that they are small."""
    records = [dict(zip(schema.names, row, strict=True)) for row in rows]
    return spark.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(records)), T.ArrayType(schema)))
    )


def default_affinity(spark: SparkSession) -> DataFrame:
    rows = [entry[1:] for entry in fixed_values.AFFINITY]
    return inline_table(spark, rows, schemas.AFFINITY)


def default_request_groups(spark: SparkSession) -> DataFrame:
    """Request type → heading of the affinity table, one row per type."""
    rows = dict.fromkeys((entry[1], entry[0]) for entry in fixed_values.AFFINITY)
    return inline_table(spark, list(rows), schemas.REQUEST_GROUPS)


def taxonomy_frame(spark: SparkSession, taxonomy: Mapping[str, Sequence[str]]) -> DataFrame:
    """Mapping group → keywords as (category_group, keyword, ordinal); ordinal is the group's position."""
    rows = [
        (group, keyword, ordinal)
        for ordinal, (group, keywords) in enumerate(taxonomy.items())
        for keyword in keywords
    ]
    return inline_table(spark, rows, schemas.TAXONOMY)


# Frequent keywords of each group, under 200 in all. The full list of a data set is a parameter:
# load a table of any size with ``sources.read_csv(..., schemas.TAXONOMY)``.
STARTER_TAXONOMY: dict[str, tuple[str, ...]] = {
    "Food & Restaurants": (
        "restaurant", "food", "dining", "diner", "cafe", "coffee", "tea", "juice", "bar", "pub", "brewery", "beer", "wine",
        "bakery", "bakerie", "donut", "bagel", "dessert", "ice cream", "breakfast", "brunch", "buffet", "catering",
        "pizza", "burger", "sandwich", "steakhouse", "seafood", "sushi", "ramen", "noodle", "chicken", "bbq", "grill",
        "taco", "cheesesteak", "soup", "salad", "deli", "chinese", "italian", "mexican", "japanese", "thai", "indian",
        "korean", "vietnamese", "mediterranean", "greek", "french", "american", "caribbean", "middle eastern",
        "halal", "tex-mex", "vegan", "vegetarian",
    ),
    "Shopping & Retail": (
        "shopping", "retail", "store", "boutique", "outlet", "clothing", "fashion", "shoes", "accessories", "jewelry",
        "grocery", "supermarket", "convenience", "home & garden", "furniture", "hardware", "electronics",
        "mobile phone", "florist", "gift", "books", "toy", "antique", "thrift", "optical", "tobacco", "vape",
    ),
    "Health & Medical": (
        "health", "medical", "doctor", "physician", "dentist", "dental", "hospital", "clinic", "urgent care", "pharmacy",
        "wellness", "chiropractor", "physical therapy", "optometrist",
    ),
    "Beauty & Spas": (
        "beauty", "spa", "salon", "hair", "nail", "massage", "skin care", "makeup", "barber", "waxing", "tattoo",
    ),
    "Automotive": (
        "automotive", "car ", "auto ", "tire", "oil change", "body shop", "car wash", "car dealer", "towing", "parking",
        "gas station", "motorcycle",
    ),
    "Home Services": (
        "home service", "contractor", "plumbing", "electrician", "hvac", "landscaping", "roofing", "painter",
        "pest control", "moving", "mover", "storage", "laundry", "dry clean", "locksmith", "apartment",
        "property management",
    ),
    "Professional Services": (
        "professional service", "lawyer", "legal", "accountant", "financial", "insurance", "real estate", "mortgage",
        "marketing", "bank", "transportation", "photographer", "event planning",
    ),
    "Entertainment & Arts": (
        "entertainment", "arts", "theater", "cinema", "museum", "gallery", "music", "nightlife", "casino", "arcade",
        "tour",
    ),
    "Active Life & Fitness": (
        "gym", "fitness", "yoga", "pilates", "sports", "recreation", "active life", "park", "golf", "martial arts",
        "dance",
    ),
    "Hotels & Travel": ("hotel", "motel", "travel", "hostel", "resort", "airport"),
    "Education": ("education", "school", "university", "college", "tutor", "preschool", "child care"),
    "Pets": ("pet", "veterinarian", "dog", "grooming"),
    "Religious Organizations": ("religious", "church", "synagogue", "mosque", "temple"),
    "Local & Community Services": ("local service", "community", "nonprofit", "post office", "library"),
}

# A short starter list in the published scale (-4..4); load a full lexicon as a table instead.
STARTER_LEXICON: tuple[tuple[str, float, str], ...] = (
    ("good", 1.9, "word"),
    ("great", 3.1, "word"),
    ("love", 3.2, "word"),
    ("nice", 1.8, "word"),
    ("bad", -2.5, "word"),
    ("terrible", -2.1, "word"),
    ("hate", -2.7, "word"),
    ("rude", -2.0, "word"),
    ("very", 0.293, "booster"),
    ("really", 0.293, "booster"),
    ("slightly", -0.293, "booster"),
    ("barely", -0.293, "booster"),
    ("not", 0.0, "negation"),
    ("never", 0.0, "negation"),
    ("without", 0.0, "negation"),
    ("bus stop", 0.0, "phrase"),
    ("yeah right", -2.0, "phrase"),
    ("kiss of death", -1.5, "phrase"),
    ("to die for", 3.0, "phrase"),
    ("beating heart", 3.1, "phrase"),
    ("broken heart", -2.9, "phrase"),
)


def default_lexicon(spark: SparkSession) -> DataFrame:
    return inline_table(spark, STARTER_LEXICON, schemas.LEXICON)
