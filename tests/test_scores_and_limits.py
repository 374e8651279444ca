"""Rounding of saved scores, hot cells by pairs, taxonomies of any size, p-values, checkpoints."""

import collections
import gc
import glob
import math
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from streetloom import schemas
from streetloom.dimensions import default_affinity, inline_table, taxonomy_frame
from streetloom.functions.categories import map_taxonomy
from streetloom.functions.rounding import half_even
from streetloom.operators import fuzzy, matching, reports
from streetloom.operators.radius import radius_join
from streetloom.operators.skew import hot_keys
from streetloom.operators.taxonomy import categorize, categorize_by_table
from streetloom.plans.businesses import clean_businesses
from streetloom.plans.integration import scored_pairs
from streetloom.session import checkpointed, shared_folder
from test_expressions import TAXONOMY
from test_operators import business_table, request_table


def test_halves_go_to_the_even_neighbour(spark):
    df = spark.createDataFrame([(0.125, 0.00025), (0.375, 0.00035), (-0.125, 0.40625), (2.675, 0.00015)], "two double, four double")
    got = [tuple(r) for r in df.select(half_even(F.col("two"), 2), half_even(F.col("four"), 4)).collect()]
    want = [(math.nan, math.nan)] * 4
    want = [(round(two * 100) / 100, round(four * 10_000) / 10_000) for two, four in [(0.125, 0.00025), (0.375, 0.00035), (-0.125, 0.40625), (2.675, 0.00015)]]
    assert got == want and got[0][0] == 0.12 and got[1][0] == 0.38


def test_scores_come_from_rounded_parts(spark):
    affinity = inline_table(spark, [("k", "P", 0.3)], schemas.AFFINITY)
    pairs = spark.createDataFrame([(1, "k", "P", 10.1251, 250.0), (2, "K", "P", 249.999, 250.0)], "id int, service_name string, primary_category string, distance double, r double")
    got = {r.id: r for r in matching.score_pairs(pairs, affinity).collect()}
    # 10.13 / 250 = 0.04052, so 0.9595 (0.95948); (0.9595 + 0.3) / 2 = 0.62975 -> 0.6298 (even)
    assert (got[1].distance_m, got[1].proximity_score, got[1].hybrid_score) == (10.13, 0.9595, 0.6298)
    assert (got[2].distance_m, got[2].proximity_score, got[2].hybrid_score) == (250.0, 0.0, 0.15)


def test_scored_pairs_have_one_schema(spark):
    requests = request_table(spark, [(i, "salting", 40.0, -75.0) for i in range(12)])
    businesses = business_table(spark, [(i, "Pets", 40.0, -75.0) for i in range(12)])
    plain, cut = (scored_pairs(requests, businesses, default_affinity(spark), hot_cell_rows=n) for n in (None, 5))
    assert plain.schema == cut.schema and plain.count() == cut.count() == 144


def test_cells_are_cut_by_pairs(spark):
    rng = random.Random(4)
    point = lambda: (40 + rng.random() / 2_000, -75 + rng.random() / 2_000)
    left = spark.createDataFrame([(i, *point()) for i in range(90)], "a int, lat double, lon double")
    right = spark.createDataFrame([(i, *point()) for i in range(60)], "b int, latitude double, longitude double")
    plain = radius_join(left, right, hot_cell_rows=None)
    # cold for each side, hot for the product
    cut = radius_join(left, right, hot_cell_rows=1_000, hot_cell_pairs=300)
    pairs = lambda df: sorted(tuple(r) for r in df.select("a", "b").collect())
    assert pairs(plain) == pairs(cut) and len(pairs(plain)) > 4_000
    keys = spark.createDataFrame([(1,)] * 90, "k int"), spark.createDataFrame([(1,)] * 60, "k int")
    hot = hot_keys(*keys, ["k"], 1_000, 300).first()
    assert math.ceil(90 / hot.left_parts) * math.ceil(60 / hot.right_parts) <= 330
    assert hot_keys(*keys, ["k"], 1_000, 6_000).count() == 0


def test_large_taxonomy_through_the_chain(spark):
    taxonomy = {f"group {g}": tuple(f"key{g}x{k}" for k in range(250)) for g in range(10)}
    row = ("1", "Joe", "1 Main", "c", "s", "19104", 40.0, -75.0, 4.0, 1, 1, "Big KEY7x249 place, key2x11, other", None, None)
    raw = spark.createDataFrame([row], schemas.BUSINESS_RAW)
    for given in (taxonomy, taxonomy_frame(spark, taxonomy)):
        got = clean_businesses(raw, given).first()
        assert got.categories_normalized[:2] == ["group 2", "group 7"] and got.primary_category == "group 2"


def test_word_form_of_the_table_agrees(spark):
    names = ["Restaurants, Bars", "Home Services", "Bar & Grill", "Tex-Mex, Zoo", None, "barn, pet", "A bar", "bar"]
    df = spark.createDataFrame(list(enumerate(names)), "id int, categories string")
    inline = categorize(df, TAXONOMY, match="word").select("id", "categories_normalized", "primary_category")
    table = categorize_by_table(df, "id", taxonomy_frame(spark, TAXONOMY), match="word").select(*inline.columns)
    assert sorted(map(tuple, inline.collect()), key=str) == sorted(map(tuple, table.collect()), key=str)
    with pytest.raises(ValueError):
        categorize_by_table(df, "id", taxonomy_frame(spark, TAXONOMY), match="other")


def test_names_are_normalised_once_whatever_the_groups(spark):
    df = spark.createDataFrame([(["a"],)], "c array<string>")

    def replacements(groups):
        mapped = map_taxonomy(F.col("c"), {f"g{k}": (f"w{k}",) for k in range(groups)})
        return df.select(mapped)._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace")

    assert replacements(3) == replacements(30)


def _tail(x, degrees):
    """By the finite sums for whole and half-whole shapes."""
    if degrees % 2 == 0:
        return math.fsum(math.exp(j * math.log(x / 2) - x / 2 - math.lgamma(j + 1)) for j in range(degrees // 2))
    rest = math.fsum(math.exp((j - 0.5) * math.log(x / 2) - x / 2 - math.lgamma(j + 0.5)) for j in range(1, (degrees - 1) // 2 + 1))
    return math.erfc(math.sqrt(x / 2)) + rest


def test_chi_square_tail(spark):
    cases = [(float(x), d) for d in (1, 2, 3, 4, 7, 53, 106, 999, 20_000) for x in (0.01, d * 0.5, d * 0.95, d, d * 1.05, d + 3 * math.sqrt(2 * d), d * 1.6 + 5)]
    df = spark.createDataFrame(cases, "x double, d long")
    for row in df.select("*", reports.chi_square_tail(F.col("x"), F.col("d")).alias("p")).collect():
        assert row.p == pytest.approx(_tail(row.x, row.d), rel=1e-8, abs=1e-12), row
    edge = spark.createDataFrame([(0.0, 5), (3.0, 0)], "x double, d long")
    assert [r.p for r in edge.select(reports.chi_square_tail(F.col("x"), F.col("d")).alias("p")).collect()] == [1.0, None]


def test_many_labels_have_a_p_value(spark):
    df = spark.range(24_000).select((F.col("id") % 12_000).cast("string").alias("a"), (F.col("id") % 2).alias("b"))
    found = reports.chi_square_test(df, "a", "b").first()
    assert found.degrees == 11_999 and found.statistic == pytest.approx(24_000) and found.p_value < 1e-9


def test_checkpoints_go_with_their_dataframes(spark):
    held = checkpointed(spark.range(10))
    parts = lambda: glob.glob(os.path.join(shared_folder(spark).removeprefix("file:"), "*", "rdd-*"))
    mine = set(parts())
    assert mine and held.count() == 10
    del held
    for _ in range(40):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if set(parts()) < mine:
            return
        time.sleep(0.25)
    raise AssertionError("no checkpoint folder was removed")


def test_character_pairs_are_numbered_by_occurrence(spark):
    rng = random.Random(1)
    texts = ["", "a", "aaaa", "abab", "é北x"] + ["".join(rng.choices("ab c", k=rng.randrange(1, 40))) for _ in range(60)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", fuzzy._character_pairs(F.col("t")).alias("pairs")).collect():
        padded = f"\x02{row.t}\x03"
        counts = collections.Counter(padded[at : at + 2] for at in range(len(padded) - 1))
        assert sorted(row.pairs) == sorted(f"{pair}{n + 1}" for pair, times in counts.items() for n in range(times))


@pytest.mark.parametrize("alphabet", ["a", "abcdefgh ij", "".join(map(chr, range(0x4E00, 0x9000)))])
def test_character_pairs_of_a_very_long_text(spark, alphabet):
    text = "".join(random.Random(2).choices(alphabet, k=100_000))
    frame = spark.createDataFrame([(text,)], "t string")
    start = time.perf_counter()
    pairs = fuzzy._character_pairs(F.col("t"))
    assert tuple(frame.select(F.size(pairs), F.size(F.array_distinct(pairs))).first()) == (100_001, 100_001)
    assert time.perf_counter() - start < 30  # quadratic work took minutes
