"""Hand-written rows for each scalar rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from streetloom.functions.categories import business_group, keyword_pattern, map_taxonomy, primary_category, split_categories
from streetloom.functions.geo import haversine_m, proximity_score, within_bounds
from streetloom.functions.labels import (
    WORD,
    has_zip_prefix,
    normalize_label,
    snake_case,
    zip_from_digits,
    zip_from_text,
)
from streetloom.functions.similarity import similarity_ratio
from streetloom.functions.text import clean_text, tokens


def values(spark, rows, expression, schema="v string"):
    df = spark.createDataFrame([(row,) if not isinstance(row, tuple) else row for row in rows], schema)
    return [row[0] for row in df.select(expression.alias("out")).collect()]


def test_zip_rules_differ_on_broken_codes(spark):
    codes = ["19104", "19104.0", "19104-1234", "PA 19103", "191-04", "1910", None]
    assert values(spark, codes, zip_from_text(F.col("v"))) == [
        "19104", "19104", "19104", "19103", None, None, None,
    ]
    assert values(spark, codes, zip_from_digits(F.col("v"))) == [
        "19104", "19104", "19104", "19103", "19104", None, None,
    ]


def test_zip_prefix(spark):
    assert values(spark, [" 19104", "19004", None, "1910"], has_zip_prefix(F.col("v"), "191")) == [
        True, False, False, True,
    ]


def test_labels_collapse_every_kind_of_blank(spark):
    labels = ["  Street\tLight   Outage ", "ABANDONED  VEHICLE", None, "\x1cx\x1f"]
    assert values(spark, labels, normalize_label(F.col("v"))) == [
        "street light outage", "abandoned vehicle", None, "x",
    ]


def test_clean_text(spark):
    texts = [
        "Great! See https://x.io/a?b=1 NOW",
        "go to www.x.org, ok",
        "...!!!",
        "Café_42 über-toll",
        None,
        "a\n b",
    ]
    assert values(spark, texts, clean_text(F.col("v"))) == [
        "great see now", "go to ok", "", "café_42 über toll", "", "a b",
    ]
    assert values(spark, ["a b", "", None], tokens(F.col("v"))) == [["a", "b"], [], []]


def test_snake_case():
    assert [snake_case(n) for n in (" Business ID", "Is Open?", "Postal  Code")] == [
        "business_id", "is_open", "postal_code",
    ]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, start=1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute_ratio(a, b):
    if a == b:
        return 100
    if not a or not b:
        return 0
    return round(200 * _lcs(a, b) / (len(a) + len(b)))


def test_similarity_ratio_on_known_pairs(spark):
    pairs = [("123 main st", "123 main street"), ("", ""), ("a", ""), ("abc", "abc"), ("kitten", "sitting")]
    expected = [85, 100, 0, 100, 62]
    assert values(spark, pairs, similarity_ratio(F.col("a"), F.col("b")), "a string, b string") == expected


def test_similarity_ratio_equals_the_table_method(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abc dé") for _ in range(rng.choice([0, 1, 5, 20, 61, 62, 63, 64, 130])))
    pairs = [(word(), word()) for _ in range(120)]
    got = values(spark, pairs, similarity_ratio(F.col("a"), F.col("b")), "a string, b string")
    assert got == [brute_ratio(a, b) for a, b in pairs]


TAXONOMY = {
    "Food & Restaurants": ["restaurant", "bar", "tea", "tex-mex"],
    "Automotive": ["rv"],
    "Home Services": ["home service"],
}


def mapped(spark, lists, match="substring"):
    rows = values(spark, lists, map_taxonomy(split_categories(F.col("v")), TAXONOMY, match))
    return rows


def test_taxonomy_takes_every_group_and_keeps_unknown_names(spark):
    assert mapped(spark, ["Restaurants, Bars", "Home Services", "Steakhouses", "Tex-Mex", "Zoo, Home Services, Aquarium", None]) == [
        ["Food & Restaurants"],
        ["Automotive", "Home Services"],  # "rv" stands inside "services"
        ["Food & Restaurants"],  # "tea" stands inside "steakhouses"
        ["texmex"],  # the hyphen is removed before matching
        ["Automotive", "Home Services", "aquarium", "zoo"],
        ["Uncategorized"],
    ]


def test_taxonomy_whole_words(spark):
    assert mapped(spark, ["Home Services", "Home Service", "Bar & Grill", "Restaurants"], "word") == [
        ["home services"], ["Home Services"], ["Food & Restaurants"], ["restaurants"],
    ]


def test_primary_category(spark):
    expression = primary_category(split_categories(F.col("v")), ("Pets", "Education"))
    assert values(spark, ["zoo,Pets", "zoo,bar", None], expression) == ["Pets", "zoo", "Uncategorized"]


def test_business_group_last_rule_wins(spark):
    expression = business_group(F.split("v", "[|]"))
    rows = ["Food & Restaurants|Home Services", "Shopping & Retail|Food & Restaurants", "RESTAURANTS", "Pets", None]
    assert values(spark, rows, expression) == ["Service", "Retail", "Restaurant", "Other", "Other"]


def test_bounds_are_inclusive_and_null_safe(spark):
    rows = [(39.5, -76.0), (40.5, -74.5), (40.6, -75.0), (95.0, -75.0), (None, -75.0), (40.0, float("nan"))]
    expression = within_bounds(F.col("lat"), F.col("lon"), (39.5, 40.5), (-76.0, -74.5))
    assert values(spark, rows, expression, "lat double, lon double") == [True, True, False, False, False, False]


def test_distance_and_proximity(spark):
    rows = [(40.0, -75.0, 40.0, -75.0), (0.0, 0.0, 0.0, 180.0), (40.0, -75.0, 40.001, -75.0)]
    out = values(
        spark, rows, haversine_m(*[F.col(c) for c in "abcd"]), "a double, b double, c double, d double"
    )
    assert out[0] == 0
    assert out[1] == pytest.approx(3.141592653589793 * 6_371_000)
    assert out[2] == pytest.approx(111.195, abs=0.01)
    assert values(spark, [0.0, 125.0, 250.0, 300.0], proximity_score(F.col("v"), 250), "v double") == [1, 0.5, 0, 0]


def test_pattern_of_many_keywords_equals_trying_each():
    rng = random.Random(3)
    parts = ["ca", "r", "wash", " ", "t", "te", "a", "&", "home", "-", "r."]
    keywords = sorted({"".join(rng.choices(parts, k=rng.randrange(1, 5))).strip() for _ in range(900)} - {""})
    assert len(keywords) > 500
    names = ["".join(rng.choices(parts + ["x", "zz"], k=rng.randrange(0, 7))) for _ in range(1_500)]
    some = rng.sample(keywords, 60)
    for words in (keywords, some, some[:1]):
        for match, found in (
            ("substring", lambda name, word: word in name),
            ("word", lambda name, word: re.search(rf"(?<!\w){re.escape(word)}(?!\w)", name) is not None),
        ):
            pattern = re.compile(keyword_pattern(words, match).replace(f"[{WORD}]", r"\w"))
            for name in names:
                assert (pattern.search(name) is not None) == any(found(name, word) for word in words), (name, match)


def test_pattern_walks_common_beginnings_once():
    assert keyword_pattern(["tea", "team", "tent"]) == "(?:te(?:a|nt))"
    assert "(?:tea(?:m)?)" in keyword_pattern(["tea", "team"], "word")
    many = [f"{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    assert len(keyword_pattern(many)) < len("|".join(many))
