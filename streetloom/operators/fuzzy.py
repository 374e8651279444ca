"""Similarity join of texts inside blocks, and de-duplication on top of it.

Two rows of a block match when the similarity ratio of their texts exceeds the threshold. Comparing all
pairs of a block would be quadratic in its rows, so the join works in three exact steps:

1. equal texts of a block collapse into one representative with its earliest row and its row count;
2. a representative is sent only to the rarest of its character pairs that any match must share
   (prefix filter), and meets others by equality on (block, pair);
3. candidates that share enough pairs altogether are verified with the exact ratio.

Why step 2 loses nothing: if the ratio exceeds t percent, LCS > c * (la + lb) with c = (t + 0.5) / 200.
Turning a into b deletes la - LCS and inserts lb - LCS characters; a deletion breaks at most two of the
la + 1 padded character pairs of a, an insertion at most one. So more than
1 + (3c - 1)(la + lb) pairs survive, and since lb > la * c / (1 - c), more than
1 + la * (3c - 1) / (1 - c). Two sets that share more than k elements must share one among their
size - k first elements in any common order; rarest-first keeps the groups small.

Representatives and their prefixes are checkpointed, because several later steps read them: the input is
computed twice at most, and calling an operator runs these two jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.fixed_values import FUZZY_THRESHOLD
from streetloom.functions.binding import bind
from streetloom.functions.similarity import characters, measured_ratio, short_masks
from streetloom.operators.skew import salted_join
from streetloom.session import checkpointed

# Texts of one block that share a character pair are cut into parts of this size, so a task compares at
# most its square. The broadcast table of such groups has at most 1/5000 as many rows as there are
# (text, pair) rows.
HOT_GROUP_ROWS = 5_000
# Candidate pairs that one task of the similarity join looks at, well under a second of work.
PAIRS_PER_TASK = 50_000


_SLACK = 1e-9  # keeps rounding of the bounds on the safe side


def _bounds(threshold: int) -> tuple[float, float, float]:
    """What every match exceeds: shorter / longer length, shared pairs (less one) per character of one
    text, and per character of both."""
    c = (threshold + 0.5) / 200
    if c <= 1 / 3:
        raise ValueError("the prefix filter needs a threshold of at least 67")
    return c / (1 - c) - _SLACK, (3 * c - 1) / (1 - c) - _SLACK, 3 * c - 1 - _SLACK


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _place(order_by: Sequence[Column]) -> Column:
    return F.struct(*[col.alias(f"o{i}") for i, col in enumerate(order_by)])


def _representatives(df: DataFrame, block: Column, text: Column, order_by: Sequence[Column]) -> DataFrame:
    """One row per (block, text): earliest place in the order and number of rows."""
    return (
        df.select(block.alias("block"), _text(text).alias("text"), _place(order_by).alias("place"))
        .where(F.col("block").isNotNull())
        .groupBy("block", "text")
        .agg(F.min("place").alias("place"), F.count("*").alias("copies"))
    )


def _character_pairs(text: Column) -> Column:
    """Padded neighbouring characters, numbered by occurrence so that the array is a set; in order of pairs.

    Equal pairs lie together once the pairs are sorted, so a run from one start to the next is numbered 1, 2, ...: the
    work grows with the text, but for the sorting.
    """
    letters = characters(F.concat(F.lit("\x02"), text, F.lit("\x03")))
    pairs = bind(
        letters,
        lambda found: F.transform(F.slice(found, F.lit(1), F.size(found) - 1), lambda ch, at: F.concat(ch, F.get(found, at + 1))),
    )

    def numbered(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1), lambda at: (at == 0) | (F.get(ordered, at) != F.get(ordered, at - 1))
        )
        return bind(
            starts,
            lambda begins: F.flatten(
                F.transform(
                    begins,
                    lambda begin, run: F.transform(
                        F.sequence(F.lit(1), F.coalesce(F.get(begins, run + 1), F.size(ordered)) - begin),
                        lambda number: F.concat(F.get(ordered, begin), number.cast("string")),
                    ),
                )
            ),
        )

    return bind(F.array_sort(pairs), numbered)


def _candidate_keys(reps: DataFrame, threshold: int) -> DataFrame:
    """Representatives with ``pairs``, all character pairs from rare to common, and ``keep``, the number of
    first ones in which a match must meet."""
    _, shared, _ = _bounds(threshold)
    # a digest stands for the text, as each of its pairs becomes a row
    digest = F.unhex(F.md5("text"))
    texts = reps.select(digest.alias("digest"), "text").dropDuplicates(["digest"])
    spread = texts.select("digest", F.explode(_character_pairs(F.col("text"))).alias("pair"))
    frequency = spread.groupBy("pair").agg(F.count("*").alias("n"))
    keep = F.length("text") + 1 - F.floor(F.length("text") * F.lit(shared) + 1)
    ordered = (
        spread.join(frequency, "pair")
        .groupBy("digest")  # bounded: one row per character pair of one text
        .agg(F.array_sort(F.collect_list(F.struct("n", "pair"))).alias("pairs"))
        .select("digest", F.transform("pairs", lambda found: found["pair"]).alias("pairs"))
    )
    kept = reps.withColumn("digest", digest).withColumn("keep", F.greatest(keep, F.lit(1)).cast("int"))
    return kept.join(ordered, "digest").drop("digest")


def _comparable(reps: DataFrame) -> DataFrame:
    """Only blocks with at least two different texts have anything to compare."""
    several = reps.groupBy("block").agg(F.count("*").alias("n")).where("n > 1").select("block")
    return reps.join(several, "block", "left_semi")


def _sides(reps: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame, Column]:
    """Earlier side, later side and the condition of a match besides equal block and character pair."""
    keyed = checkpointed(_candidate_keys(_comparable(reps.where(F.length("text") > 0)), threshold))
    # masks are made once per text and travel with it, instead of once per candidate pair
    early = keyed.withColumn("masks", short_masks(F.col("text"))).withColumn("pair", F.explode(F.slice("pairs", F.lit(1), F.col("keep")))).drop("keep")
    late = keyed.withColumn("pair", F.explode(F.slice("pairs", F.lit(1), F.col("keep")))).drop("keep")
    names = ["text", "place", "copies", "pairs"]
    early = early.withColumnsRenamed({name: f"{name}_a" for name in [*names, "masks"]})
    late = late.withColumnsRenamed({name: f"{name}_b" for name in names})
    shorter, _, shared = _bounds(threshold)
    length_a, length_b = F.length("text_a"), F.length("text_b")
    meet = (
        (F.col("place_a") < F.col("place_b"))
        & (F.least(length_a, length_b) > F.greatest(length_a, length_b) * F.lit(shorter))
        # the two texts meet once, at the first element they share, and must share enough of them
        & bind(
            F.array_intersect("pairs_a", "pairs_b"),
            lambda common: (F.get(common, F.lit(0)) == F.col("pair"))
            & (F.size(common) > (length_a + length_b) * F.lit(shared) + 1),
        )
    )
    return early, late, meet


def _ratio() -> Column:
    return measured_ratio(F.col("text_a"), F.col("text_b"), F.col("masks_a"))


def similar_texts(
    df: DataFrame,
    block: Column,
    text: Column,
    order_by: Sequence[Column],
    threshold: int = FUZZY_THRESHOLD,
) -> DataFrame:
    """Similar pairs of different texts in one block, the earlier text first.

    ``copies_a`` and ``copies_b`` say how many rows carry each text, so the row pairs behind a result
    row are counted without listing them.
    """
    reps = checkpointed(_representatives(df, block, text, order_by))
    early, late, meet = _sides(reps, threshold)
    ratio = _ratio()
    met = salted_join(
        early, late, ["block", "pair"], HOT_GROUP_ROWS, ["text_a"], ["text_b"], meet, pairs_per_task=PAIRS_PER_TASK
    )
    return (
        met
        # one evaluation: a plain filter on the column would compute it a second time
        .withColumn("ratio", F.explode(F.filter(F.array(ratio), lambda found: found > threshold)))
        .select(
            "block", "text_a", "text_b", "place_a", "place_b", "copies_a", "copies_b", "ratio",
        )
    )


def fuzzy_dedup(
    df: DataFrame,
    block: Column,
    text: Column,
    order_by: Sequence[Column],
    threshold: int = FUZZY_THRESHOLD,
) -> DataFrame:
    """Drop every row that follows a similar row of its block, in ``order_by`` (end it with a unique column).

    A row that is itself dropped still marks later rows. Rows with a null block are kept.
    """
    reps = checkpointed(_representatives(df, block, text, order_by))
    early, late, meet = _sides(reps, threshold)
    matches = meet & (_ratio() > threshold)
    marked = (
        salted_join(
            late, early, ["block", "pair"], HOT_GROUP_ROWS, ["text_b"], ["text_a"], matches, "left_semi", PAIRS_PER_TASK
        )
        .select(F.col("block").alias("_block"), F.col("text_b").alias("_text"))
        .distinct()
    )
    # survivors: the earliest row of each text that is not marked; found by its unique place, so a
    # block or text with many copies does not pile up in one task
    firsts = (
        reps.join(marked, (F.col("block") == F.col("_block")) & (F.col("text") == F.col("_text")), "left_anti")
        .select(F.col("block").alias("_block"), F.col("text").alias("_text"), F.col("place").alias("_first"))
    )
    placed = df.withColumns({"_b": block, "_t": _text(text), "_place": _place(order_by)})
    same = (
        (F.col("_b") == F.col("_block")) & (F.col("_t") == F.col("_text")) & (F.col("_place") == F.col("_first"))
    )
    kept = placed.where(F.col("_b").isNotNull()).join(firsts, same, "left_semi")
    loose = placed.where(F.col("_b").isNull())
    return kept.unionByName(loose).drop("_b", "_t", "_place")
