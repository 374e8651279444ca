"""Taxonomy mapping on tables: groups, unmatched names and the primary category."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.fixed_values import UNCATEGORIZED
from streetloom.functions.categories import (
    map_taxonomy,
    normalize_category,
    primary_category,
    split_categories,
)
from streetloom.functions.labels import WORD


def categorize(
    df: DataFrame,
    taxonomy: Mapping[str, Sequence[str]],
    categories: str = "categories",
    match: str = "substring",
) -> DataFrame:
    """Add ``categories_normalized`` and ``primary_category`` without moving a row.

    The taxonomy becomes part of the expression; a table of thousands of keywords is better given to
    ``categorize_by_table``.
    """
    mapped = map_taxonomy(split_categories(F.col(categories)), taxonomy, match)
    return df.withColumn("categories_normalized", mapped).withColumn(
        "primary_category", primary_category(F.col("categories_normalized"), tuple(taxonomy))
    )


def name_groups(names: DataFrame, taxonomy: DataFrame, match: str = "substring") -> DataFrame:
    """(name, groups) for distinct normalised names and a taxonomy table of any size.

    A keyword inside a name is one of the name's substrings, so the match is an equality join on
    substrings of the lengths that keywords have, not a comparison of every name with every keyword.
    With ``match='word'`` only substrings that neither begin nor end inside a word count.
    ``groups`` is an array of (ordinal, category_group) in order.
    """
    lengths = taxonomy.select(F.length("keyword").alias("size")).distinct()
    if match not in ("substring", "word"):
        raise ValueError(f"match must be 'substring' or 'word', not {match!r}")

    def counts(at: Column, size: Column) -> Column:
        around = F.concat(F.lit(" "), F.col("name"), F.lit(" "))
        before, after = F.substring(around, at, F.lit(1)), F.substring(around, at + size + 1, F.lit(1))
        return ~before.rlike(f"[{WORD}]") & ~after.rlike(f"[{WORD}]")

    def pieces_of(size: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length("name") - size + 1)
        if match == "word":
            starts = F.filter(starts, lambda at: counts(at, size))
        return F.transform(starts, lambda at: F.substring(F.col("name"), at, size))

    sizes = lengths.agg(F.array_sort(F.collect_set("size")).alias("sizes"))  # at most the longest keyword
    pieces = names.select("name", sizes.scalar().alias("sizes")).select(
        "name",
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(F.filter("sizes", lambda size: size <= F.length("name")), pieces_of)
                )
            )
        ).alias("piece"),
    )
    return (
        pieces.join(taxonomy, F.col("piece") == F.col("keyword"))
        .groupBy("name")
        .agg(F.array_sort(F.collect_set(F.struct("ordinal", "category_group"))).alias("groups"))
    )


def categorize_by_table(
    df: DataFrame, key: str, taxonomy: DataFrame, categories: str = "categories", match: str = "substring"
) -> DataFrame:
    """Like ``categorize`` for a taxonomy table (category_group, keyword, ordinal); ``key`` is unique.

    Each distinct name is matched once and joined back.
    """
    listed = df.select(
        F.col(key).alias("_key"),
        F.explode(F.transform(split_categories(F.col(categories)), normalize_category)).alias("name"),
    )
    matched = name_groups(listed.select("name").distinct(), taxonomy, match)
    per_row = (
        listed.join(matched, "name", "left")
        .groupBy("_key")  # bounded: the categories of one row
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("groups")))).alias("groups"),
            F.array_sort(
                F.collect_set(
                    F.when(F.col("groups").isNull() & (F.col("name") != UNCATEGORIZED.lower()), F.col("name"))
                )
            ).alias("rest"),
        )
        .select(
            "_key",
            F.concat(F.transform("groups", lambda g: g["category_group"]), F.col("rest")).alias("mapped"),
        )
    )
    mapped = F.when(F.size("mapped") > 0, F.col("mapped")).otherwise(F.array(F.lit(UNCATEGORIZED)))
    return (
        df.join(per_row, F.col(key) == F.col("_key"))
        .withColumn("categories_normalized", mapped)
        .withColumn("primary_category", F.get("categories_normalized", F.lit(0)))
        .drop("_key", "mapped")
    )
