"""Operators on small tables, against brute force where there is one."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from streetloom import schemas
from streetloom.dimensions import (
    default_affinity,
    default_request_groups,
    inline_table,
    taxonomy_frame,
)
from streetloom.operators import cluster, dedup, fuzzy, hotspots, matching, profile, reports
from streetloom.operators import sentiment as senti
from streetloom.operators.columns import drop_missing, snake_case_columns
from streetloom.operators.radius import radius_join
from streetloom.operators.taxonomy import categorize, categorize_by_table
from streetloom.plans.integration import match_pairs
from test_expressions import TAXONOMY, brute_ratio


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*order).collect()]


# ---- de-duplication


def test_keep_first_follows_the_order_and_groups_nulls(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None), (4, "b")], "n int, k string")
    assert rows(dedup.keep_first(df, ["k"], ["n"]), "n") == [(1, "a"), (2, None), (4, "b")]


def test_keep_first_limits_rows_before_the_exchange(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedup.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_event_dedup(spark):
    df = spark.createDataFrame(
        [
            (1, "x", 40.00001, -75.0, "2024-01-01 10:00:00"),
            (2, "x", 40.00002, -75.0, "2024-01-01 23:00:00"),
            (3, "x", 40.00001, -75.0, "2024-01-02 10:00:00"),
            (4, "X", 40.00001, -75.0, "2024-01-01 10:00:00"),
            (5, "x", 40.0002, -75.0, "2024-01-01 10:00:00"),
        ],
        "id int, service_name string, lat double, lon double, requested_datetime string",
    )
    assert [row[0] for row in rows(dedup.keep_first_event(df, ["id"]), "id")] == [1, 3, 4, 5]


def test_duplicate_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(dedup.duplicate_rows(df, ["k"]), "duplicate_rows") == [(4, 2)]


def shops(spark, seed, n=90):
    rng = random.Random(seed)
    streets = ["market st", "market street", "walnut st", "broad ave", ""]
    data = []
    for i in range(n):
        address = rng.choice(streets)
        if address and rng.random() < 0.8:
            address = f"{rng.randint(1, 40)} {address}"
        data.append((i, rng.choice(["bar", "cafe", None]), address or rng.choice(["", None]), rng.randint(0, 4)))
    return data, spark.createDataFrame(data, "id int, name string, address string, reviews int")


def terms():
    return {"block": F.col("name"), "text": F.lower("address"), "order_by": [-F.col("reviews"), F.col("id")]}


@pytest.mark.parametrize("hot", [5_000, 3])
def test_fuzzy_dedup_equals_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(fuzzy, "HOT_GROUP_ROWS", hot)
    for seed in (1, 2):
        data, df = shops(spark, seed)
        ordered = sorted(data, key=lambda r: (-r[3], r[0]))
        dropped = set()
        for i, a in enumerate(ordered):
            for b in ordered[i + 1 :]:
                if a[1] is not None and a[1] == b[1] and brute_ratio(a[2] or "", b[2] or "") > 80:
                    dropped.add(b[0])
        kept = [row[0] for row in rows(fuzzy.fuzzy_dedup(df, **terms()), "id")]
        assert kept == sorted(r[0] for r in data if r[0] not in dropped)
        assert dropped


def test_similar_texts_count_all_row_pairs(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "HOT_GROUP_ROWS", 4)
    data, df = shops(spark, 3)
    texts = defaultdict(Counter)
    for _, name, address, _ in data:
        if name is not None:
            texts[name][address or ""] += 1
    want = sum(
        n * m
        for group in texts.values()
        for a, n in group.items()
        for b, m in group.items()
        if a < b and brute_ratio(a, b) > 80
    )
    found = fuzzy.similar_texts(df, **terms())
    got = found.agg(F.sum(F.col("copies_a") * F.col("copies_b")), F.count("*"), F.count_distinct("block", "text_a", "text_b")).first()
    assert got[0] == want
    assert got[1] == got[2]


@pytest.mark.parametrize("threshold", [67, 80, 95])
def test_prefix_filter_loses_no_match(spark, threshold):
    rng = random.Random(threshold)
    words = {"".join(rng.choice("ab1 ") for _ in range(rng.randint(1, 12))) for _ in range(100)}
    for _ in range(8):  # long texts and their copies with one letter less or more
        text = "".join(rng.choice("abcd 12") for _ in range(rng.choice([25, 40, 70])))
        words |= {text, text[1:], text[:9] + text[10:], text + "x", text[:5] + "y" + text[5:]}
    words = sorted(words)
    df = spark.createDataFrame([("x", word, i) for i, word in enumerate(words)], "b string, t string, i int")
    found = fuzzy.similar_texts(df, F.col("b"), F.col("t"), [F.col("i")], threshold)
    want = {
        (a, b) for i, a in enumerate(words) for b in words[i + 1 :] if brute_ratio(a, b) > threshold
    }
    assert {(row.text_a, row.text_b) for row in found.collect()} == want
    assert want


def test_fuzzy_dedup_is_idempotent_on_chains(spark):
    df = spark.createDataFrame(
        [(1, "n", "aaaaaaaaaa"), (2, "n", "aaaaaaaaab"), (3, "n", "aaaaaaaabb"), (4, "n", "zzzz")],
        "id int, name string, address string",
    )
    once = fuzzy.fuzzy_dedup(df, F.col("name"), F.col("address"), [F.col("id")])
    # 2 is dropped by 1 and still marks 3
    assert [row.id for row in once.orderBy("id").collect()] == [1, 4]
    twice = fuzzy.fuzzy_dedup(once, F.col("name"), F.col("address"), [F.col("id")])
    assert rows(once, "id") == rows(twice, "id")


# ---- radius join


def haversine(a, b):
    la, lo, lb, lp = map(math.radians, (*a, *b))
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize(
    ("centre", "spread", "radius"),
    [((40.0, -75.0), 0.02, 250), ((0.0, 179.99), 0.05, 2_000), ((89.95, 10.0), 0.2, 5_000), ((-60.0, -179.9), 1.5, 60_000)],
)
@pytest.mark.parametrize("hot", [None, 1_000_000, 2])
def test_radius_join_equals_brute_force(spark, centre, spread, radius, hot):
    rng = random.Random(radius)

    def points(n):
        made = []
        for i in range(n):
            lat = max(-90.0, min(90.0, centre[0] + rng.uniform(-spread, spread)))
            lon = centre[1] + rng.uniform(-spread, spread) * (30 if abs(centre[0]) > 80 else 1)
            made.append((i, lat, (lon + 180) % 360 - 180))
        return made + [(n + 1, centre[0], centre[1]), (n + 2, None, 0.0)]

    left, right = points(60), points(50)
    found = radius_join(
        spark.createDataFrame(left, "l int, lat double, lon double"),
        spark.createDataFrame(right, "r int, latitude double, longitude double"),
        radius,
        hot_cell_rows=hot,
    )
    got = sorted((row.l, row.r) for row in found.collect())
    want = sorted(
        (a[0], b[0])
        for a in left
        for b in right
        if a[1] is not None and b[1] is not None and haversine(a[1:], b[1:]) <= radius
    )
    assert got == want
    assert want


def test_radius_join_has_no_nested_loop(spark):
    left = spark.range(10).selectExpr("id as l", "40D + id / 1000 as lat", "-75D + id / 1000 as lon")
    right = spark.range(10).selectExpr("id as r", "40D + id / 900 as latitude", "-75D + id / 900 as longitude")
    plan = radius_join(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_radius_join_refuses_clashing_names(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0)], "id int, lat double, lon double")
    with pytest.raises(ValueError, match="both sides"):
        radius_join(df, df)


# ---- matching


def request_table(spark, data):
    return spark.createDataFrame(
        [(i, name, "s", "a", "2024-01-01 00:00:00", "addr", "19104", lat, lon) for i, name, lat, lon in data],
        "service_request_id long, service_name string, subject string, agency_responsible string,"
        " requested_datetime string, address string, zipcode string, lat double, lon double",
    )


def business_table(spark, data):
    return spark.createDataFrame(
        [(i, f"b{i}", "addr", "19104", lat, lon, 4.0, 10, cat, [cat]) for i, cat, lat, lon in data],
        "business_id long, name string, address string, postal_code string, latitude double, longitude double,"
        " stars double, review_count long, primary_category string, categories_normalized array<string>",
    )


def test_match_pairs_scores_and_ranks(spark):
    requests = request_table(spark, [(1, "Abandoned Vehicle", 40.0, -75.0), (2, None, 40.0, -75.0), (3, "x", 41.0, -75.0)])
    businesses = business_table(
        spark,
        [(10, "Automotive", 40.001, -75.0), (11, "Pets", 40.0, -75.0), (12, None, 40.0, -75.0), (13, "Pets", 40.01, -75.0)],
    )
    found = match_pairs(requests, businesses, default_affinity(spark))
    assert len(found.columns) == 24
    got = rows(
        found.select("service_request_id", "match_rank", "business_id", "distance_m", "proximity_score", "category_similarity", "hybrid_score"),
        "service_request_id", "match_rank",
    )
    assert got == [
        (1, 1, 10, 111.19, 0.5552, 1.0, 0.7776),
        (1, 2, 11, 0.0, 1.0, 0.0, 0.5),
        (1, 3, 12, 0.0, 1.0, 0.0, 0.5),
        (2, 1, 11, 0.0, 1.0, 0.0, 0.5),
        (2, 2, 12, 0.0, 1.0, 0.0, 0.5),
        (2, 3, 10, 111.19, 0.5552, 0.0, 0.2776),
    ]
    closest = matching.closest_match(found).select("service_request_id", "business_id")
    assert rows(closest, "service_request_id") == [(1, 11), (2, 11)]


def test_match_pairs_without_match_is_empty_with_columns(spark):
    found = match_pairs(
        request_table(spark, [(1, "x", 0.0, 0.0)]), business_table(spark, [(1, "Pets", 10.0, 10.0)]), default_affinity(spark)
    )
    assert found.count() == 0 and len(found.columns) == 24


def test_ranks_do_not_depend_on_how_requests_are_cut(spark):
    rng = random.Random(11)
    near = lambda: (40 + rng.choice([0, rng.random() / 500]), -75 + rng.choice([0, rng.random() / 500]))
    requests = request_table(spark, [(i, rng.choice(["salting", "none"]), *map(float, near())) for i in range(25)])
    businesses = business_table(
        spark, [(i, rng.choice(["Home Services", "Pets"]), *map(float, near())) for i in range(60)]
    )
    affinity = default_affinity(spark)
    plain = match_pairs(requests, businesses, affinity, hot_cell_rows=None)
    cut = match_pairs(requests, businesses, affinity, hot_cell_rows=7)
    assert rows(plain, "service_request_id", "match_rank") == rows(cut, "service_request_id", "match_rank")
    per_request = defaultdict(list)
    for row in cut.collect():
        per_request[row.service_request_id].append(row.match_rank)
    assert all(sorted(ranks) == list(range(1, len(ranks) + 1)) for ranks in per_request.values())


def test_ranks_of_ids_that_come_again_in_other_cells_or_are_null(spark):
    rng = random.Random(5)
    place = lambda: (40 + rng.random() / 100, -75 + rng.random() / 100)
    requests = request_table(spark, [(rng.choice([1, 2, 3, None, 10 + i]), "salting", *place()) for i in range(40)])
    businesses = business_table(spark, [(i, "Pets", *place()) for i in range(80)])
    for hot in (None, 5, 1_000):
        found = match_pairs(requests, businesses, default_affinity(spark), hot_cell_rows=hot).collect()
        ranked = defaultdict(list)
        for row in found:
            ranked[row.service_request_id].append((-row.hybrid_score, row.distance_m, row.match_rank))
        assert len(found) > 100 and None in ranked
        for matches in ranked.values():
            assert sorted(rank for *_, rank in matches) == list(range(1, len(matches) + 1))
            by_rank = sorted(matches, key=lambda match: match[2])
            assert [match[:2] for match in by_rank] == sorted(match[:2] for match in matches)


def test_pairs_are_ranked_where_the_join_left_them(spark):
    requests = request_table(spark, [(i, "salting", 40 + i / 1e4, -75.0) for i in range(50)])
    businesses = business_table(spark, [(i, "Pets", 40 + i / 1e4, -75.0) for i in range(50)])
    plan = match_pairs(requests, businesses, default_affinity(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(service_request_id" in line]


def test_affinity_keys(spark):
    table = inline_table(spark, [("a", "P", 0.5), ("Raw", "P", 0.7), ("B", "P", 0.1), ("b", "Q", 0.2)], schemas.AFFINITY)
    df = spark.createDataFrame([("A", "P"), ("Raw", "P"), ("raw", "P"), ("B", "P"), (None, "P")], "service_name string, primary_category string")
    lower_only = {r[0]: r[2] for r in matching.with_affinity(df, table).collect()}
    assert lower_only == {"A": 0.5, "Raw": 0.0, "raw": 0.0, "B": 0.0, None: 0.0}
    both = {r[0]: r[2] for r in matching.with_affinity(df, table, raw_keys=True).collect()}
    # "B" is in the table in lower case, so its written form is not used
    assert both == {"A": 0.5, "Raw": 0.7, "raw": 0.0, "B": 0.0, None: 0.0}
    assert rows(matching.affinity_coverage(df, table), "kinds") == [(5 - 0, 3)]


def test_default_tables(spark):
    affinity = default_affinity(spark)
    assert affinity.count() == 96
    assert affinity.select("service_name").distinct().count() == 47
    assert default_request_groups(spark).groupBy("request_group").count().count() == 8


# ---- categories


def test_table_form_of_the_taxonomy_agrees(spark):
    df = spark.createDataFrame(
        [(1, "Restaurants, Bars"), (2, "Home Services"), (3, "Tex-Mex, Zoo"), (4, None), (5, "Uncategorized, Home Services, Zoo,"), (6, "Steakhouses")],
        "id int, categories string",
    )
    inline = categorize(df, TAXONOMY).select("id", "categories_normalized", "primary_category")
    table = categorize_by_table(df, "id", taxonomy_frame(spark, TAXONOMY)).select("id", "categories_normalized", "primary_category")
    assert rows(inline, "id") == rows(table, "id")


# ---- sentiment


PHRASE_LEXICON = [
    ("good", 2.0, "word"), ("bad", -2.0, "word"), ("no", -1.0, "word"), ("kind", 2.0, "word"), ("doubt", -1.5, "word"),
    ("very", 0.3, "booster"), ("kind of", -0.3, "booster"), ("never", 0.0, "negation"), ("without", 0.0, "negation"),
]


@pytest.mark.parametrize(
    ("text", "total"),
    [
        ("it is least good", 2 * -0.74),
        ("least good", 2 * -0.74),
        ("at least good", 2.0),
        ("very least good", 2 + 0.3 * 0.95),
        ("never so good", 2 * 1.25),
        ("never x good", 2 * -0.74),
        ("never x this good", 2 * 1.25),
        ("never this x good", 2 * 1.25),
        ("a b so good", 2 * 1.25),
        ("b so good", 2.0),
        ("without a good", 2 * -0.74),
        ("without doubt good", -1.5 * -0.74 + 2.0),
        ("no good", 0 + 2 * -0.74),
        ("no x bad", -1 + -2 * -0.74),
        ("no x or bad", -1 + -2 * -0.74),
        ("no x y bad", -1 + -2),
        ("no", -1.0),
        ("x kind of good", 2.0 - 0.3),
        ("kind of good", 2.0),
        ("kind good", 4.0),
        ("kind", 2.0),
        ("", 0.0),
    ],
)
def test_rules_of_several_words(spark, text, total):
    lexicon = inline_table(spark, PHRASE_LEXICON, schemas.LEXICON)
    df = spark.createDataFrame([("r", "b", text)], "review_id string, business_id string, text_clean string")
    got = senti.lexicon_sentiment(df, lexicon).first().review_sentiment
    assert got == pytest.approx(total / math.sqrt(total * total + 15), abs=5.1e-5)


@pytest.mark.parametrize(
    ("text", "total"),
    [
        ("a b c kiss of death", -1.5),
        ("kiss of death", 2.0),  # too near the beginning, so the word counts
        ("a b kiss of death", 2.0),
        ("a b c kiss of", -0.5),  # two tokens, as the third is missing
        ("a b c kiss of life", -0.5),
        ("a b c broken kiss", -2.9),  # ends with the word
        ("a b c broken kiss of", -0.5),  # ahead wins
        ("a b c broken kiss of death", -1.5),  # the longer one ahead wins
        ("a big broken kiss", -2.9),  # the shorter one behind wins
        ("a b to die kiss", 0.9),  # directly before the word
        ("a to die for kiss", 3.0),  # three tokens that end before it
        ("a to die x kiss", 0.9),  # two tokens, one before it
        ("a b c to die x y kiss", 2.0),
        ("never to die kiss", 0.9),  # in place of what negations made of it
        ("kiss to die kiss", 2.0 + 2.0),  # a word stands third before
        ("a b very big kiss", 2 + 0.3 * 0.95),
        ("a just a bit kiss", 2.0 - 0.2 - 0.1),  # boosters of two and of three tokens both add
        ("a b c kiss of death but x", -0.75),
        ("bus", 0.0),
    ],
)
def test_phrases_of_several_words(spark, text, total):
    phrases = [
        ("kiss", 2.0, "word"), ("never", 0.0, "negation"), ("very", 0.3, "booster"), ("just a bit", -0.2, "booster"), ("a bit", -0.1, "booster"),
        ("kiss of death", -1.5, "phrase"), ("kiss of", -0.5, "phrase"), ("broken kiss", -2.9, "phrase"), ("big broken kiss", 1.0, "phrase"),
        ("to die for", 3.0, "phrase"), ("to die", 0.9, "phrase"), ("bus stop", 1.0, "phrase"), ("one two three four", 4.0, "phrase"),
    ]
    df = spark.createDataFrame([("r", "b", text)], "review_id string, business_id string, text_clean string")
    got = senti.lexicon_sentiment(df, inline_table(spark, phrases, schemas.LEXICON)).first().review_sentiment
    assert got == pytest.approx(total / math.sqrt(total * total + 15), abs=5.1e-5)


def test_texts_are_not_exchanged_for_their_sentiment(spark):
    lexicon = inline_table(spark, PHRASE_LEXICON, schemas.LEXICON)
    df = spark.createDataFrame([("r", None, "good text"), ("s", "b", None)], "review_id string, business_id string, text_clean string")
    scored = senti.lexicon_sentiment(df, lexicon)
    assert {tuple(r) for r in scored.collect()} == {("r", None, 0.4588), ("s", "b", 0.0)}
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange hash" in line and "text_clean" in line for line in plan.splitlines())


def sentiment_of(spark, texts, contrast=("but",)):
    lexicon = inline_table(
        spark,
        [("good", 2.0, "word"), ("bad", -2.0, "word"), ("very", 0.3, "booster"), ("barely", -0.3, "booster"),
         ("not", 0.0, "negation"), ("no", -1.0, "word"), ("no", 0.0, "negation")],
        schemas.LEXICON,
    )
    df = spark.createDataFrame([(i, "b", text) for i, text in enumerate(texts)], "review_id int, business_id string, text_clean string")
    scored = senti.lexicon_sentiment(df, lexicon, contrast=contrast)
    return [row.review_sentiment for row in scored.orderBy("review_id").collect()]


def norm(total):
    return round(total / math.sqrt(total * total + 15), 4)


def test_sentiment_rules(spark):
    cases = {
        "good": 2.0,
        "bad": -2.0,
        "very good": 2.3,
        "very bad": -2.3,
        "barely good": 1.7,
        "very x good": 2 + 0.3 * 0.95,
        "very x y good": 2 + 0.3 * 0.9,
        "very x y z good": 2.0,
        "not good": 2 * -0.74,
        "not x y good": 2 * -0.74,
        "very not good": 2 * -0.74 - 0.3 * 0.95,
        "good but bad": 1.0 - 3.0,
        "but good": 3.0,
        "no good": 2 * -0.74,  # before a word "no" turns it and is silent itself
        "no": -1.0,
        "x y": 0.0,
        "": 0.0,
        "very": 0.0,
    }
    assert sentiment_of(spark, [*cases, None]) == [norm(total) for total in cases.values()] + [0.0]


def test_sentiment_plan_has_one_exchange_of_texts(spark):
    lexicon = inline_table(spark, [("good", 2.0, "word")], schemas.LEXICON)
    df = spark.createDataFrame([(1, "b", "good")], "review_id int, business_id string, text_clean string")
    plan = senti.lexicon_sentiment(df, lexicon)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(review_id") == 1
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_rollup(spark):
    df = spark.createDataFrame(
        [("a", 0.5), ("a", 0.05), ("a", -0.05), ("a", 0.0), ("b", 0.3), (None, 0.1)], "business_id string, review_sentiment double"
    )
    rolled = senti.sentiment_by_business(df)
    assert rows(rolled, "business_id") == [
        ("a", 0.125, 0.025, 0.2533, 4, 50.0, 25.0),
        ("b", 0.3, 0.3, None, 1, 100.0, 0.0),
    ]
    assert rows(senti.sentiment_distribution(df), "polarity") == [
        ("negative", 1, 16.7), ("neutral", 1, 16.7), ("positive", 4, 66.7),
    ]
    assert [r[:2] for r in rows(senti.sentiment_extremes(rolled, 1), "side")] == [("most negative", "a"), ("most positive", "b")]


# ---- reports


def test_top_per_month_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("2024-01-05 00:00:00", k) for k in "bbaac"] + [("2023-01-09 00:00:00", "a"), (None, "z"), ("bad", "z")],
        "requested_datetime string, service_name string",
    )
    got = rows(reports.top_per_month(df, 2).select("month", "service_name", "n", "place"), "place")
    assert got == [("January", "a", 3, 1), ("January", "b", 2, 2)]
    months = rows(reports.monthly_counts(df), "month_no")
    assert len(months) == 12 and months[0] == (1, "January", 6) and months[1] == (2, "February", 0)
    assert rows(reports.monthly_counts(df, by_year=True), "year") == [(2023, 1, "January", 1), (2024, 1, "January", 5)]


def test_chi_square_counts_empty_cells(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("b", "y")] * 2 + [("b", "x"), (None, "x")], "g string, z string")
    found = reports.chi_square(df, "g", "z").first()
    observed = {("a", "x"): 3, ("a", "y"): 0, ("b", "x"): 1, ("b", "y"): 2}
    expected = sum((o - e) ** 2 / e for (g, z), o in observed.items() for e in [{"a": 3, "b": 3}[g] * {"x": 4, "y": 2}[z] / 6])
    assert found.statistic == pytest.approx(expected)
    assert (found.degrees, found.n) == (1, 6)
    tested = reports.chi_square_test(df, "g", "z").first()
    assert tested.statistic == pytest.approx(expected) and tested.degrees == 1 and 0 < tested.p_value < 1


def test_density_and_null_zip(spark):
    df = spark.createDataFrame([("1", 1, 1), ("1", 1, 2), ("1", 2, 2), ("2", 3, 1), (None, 4, 4)], "zipcode_request string, service_request_id int, business_id int")
    assert rows(reports.zip_density(df), "zipcode") == [("1", 3, 2), ("2", 1, 1)]
    assert rows(reports.zip_density(df, distinct_requests=True), "zipcode") == [("1", 2, 2), ("2", 1, 1)]
    fit = reports.density_fit(reports.zip_density(df)).first()
    assert (fit.slope, fit.intercept, fit.r2) == pytest.approx((2, -1, 1))


def test_group_share_and_compare(spark):
    df = spark.createDataFrame([("Illegal Dumping",)] * 3 + [("salting",)] + [("none",)], "service_name string")
    shares = {r.request_group: (r.n, r.pct) for r in reports.group_share(df, default_request_groups(spark)).collect()}
    assert shares == {"Sanitation / waste": (3, 60.0), "Infrastructure / streets": (1, 20.0), "ungrouped": (1, 20.0)}
    compared = reports.compare_groups(df, F.lit("g"), k=2)
    assert rows(compared, "service_name") == [("Illegal Dumping", "g", 3), ("none", "g", 1)]


# ---- profiles, bins, clusters


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "x", 1.0)], "a int, b string, c double")
    assert rows(profile.null_profile(df), "column") == [("b", 1, 50.0), ("c", 1, 50.0)]
    first = rows(profile.table_profile(df, ["a"]), "position")
    assert first[0] == (1, "a", "int", 2, "1")


def test_drop_missing_policies(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (None, "x", "y")], "a int, b string, c string")
    assert rows(drop_missing(df, all_of=["a"], any_of=["b", "c"]), "a") == [(2, "x", None)]


def test_snake_case_columns_refuse_collisions(spark):
    with pytest.raises(ValueError, match="collide"):
        snake_case_columns(spark.createDataFrame([(1, 2)], ["A b", "a  B"]))


def test_hexbin_keeps_every_point(spark):
    rng = random.Random(5)
    points = [(rng.random(), rng.random() * 2) for _ in range(500)] + [(None, 1.0)]
    df = spark.createDataFrame(points, "x double, y double")
    assert hotspots.hexbin(df, "x", "y").agg(F.sum("n")).first()[0] == 500
    few = hotspots.hexbin(df, "x", "y", gridsize=3, mincnt=60)
    assert few.where("n < 60").count() == 0
    flat = spark.createDataFrame([(1.0, 0.0)] * 4, "x double, y double")
    assert hotspots.hexbin(flat, "x", "y").agg(F.sum("n")).first()[0] == 4


def test_clusters(spark):
    rng = random.Random(3)
    data = [(i, round(c + rng.random() / 10, 2), float(c)) for i in range(200) for c in [[0, 1, 2, 3][i % 4]]]
    df = spark.createDataFrame(data, "id int, proximity_score double, category_similarity double")
    scaled = cluster.standardize(df).agg(F.avg("proximity_score_z"), F.stddev_pop("proximity_score_z")).first()
    assert tuple(scaled) == pytest.approx((0, 1))
    curve = [r.inertia for r in cluster.kmeans_elbow(df, ks=(2, 3, 4, 5), n_init=3).orderBy("k").collect()]
    assert all(a >= b - 1e-6 for a, b in zip(curve, curve[1:]))
    assigned = cluster.kmeans_assign(df, k=4, n_init=3)
    profile_rows = rows(cluster.cluster_profile(assigned), "cluster")
    assert [r[1] for r in profile_rows] == [50, 50, 50, 50]
    assert [r[3] for r in profile_rows] == [0, 1, 2, 3]
