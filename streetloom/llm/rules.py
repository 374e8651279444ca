"""Quality rules whose cutoffs are chosen under risk control, in DataFrame and SQL functions only.

Each rule rejects texts whose measure exceeds a cutoff. Texts labelled good are the holdout: within a stratum
(language) a cutoff is certified when the exact binomial tail P(X <= k | n, a) of its k false rejections among n good
texts is at most the rule's error level, so that the true share of good texts lost exceeds ``a`` with at most that
probability. Candidate cutoffs are fixed beforehand and tested from lax to strict, stopping at the first that
fails (a fixed sequence needs no correction within it); the error level ``CONFIDENCE`` is divided by strata times
rules (Bonferroni), the loss ``MAX_LOSS`` by rules, so a stratum loses at most ``MAX_LOSS`` of its good texts
to all rules together. Where the holdout is too small to certify anything, a rule rejects nothing.

Defined results: a null or empty text has no words and fails; a null stratum is a stratum; a text whose labels
disagree, or are null, is not good; labels without a text do not count; without labels only the base rule
acts. Rows that repeat are judged one by one. Names in the caller's table cannot clash: rows travel in a struct.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions.binding import bind
from streetloom.session import checkpointed

MAX_LOSS = 0.01
CONFIDENCE = 0.05
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_BROADCAST_IDS = 1_000_000  # of good texts
MAX_BROADCAST_STRATA = 10_000  # rows of the table of cutoffs that may be broadcast

# cutoffs from lax to strict; a text is rejected when its measure is larger
CUTOFFS: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05),
    "duplicate_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeated_word_share": (0.2, 0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06, 0.04),
    "letters_per_word": (200.0, 100.0, 50.0, 30.0, 20.0, 15.0, 12.0, 10.0),
}
_BREAK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside windows of five that occur at least twice in the text."""
    starts = F.sequence(F.lit(0), n - WINDOW)
    hashes = F.transform(starts, lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(WINDOW)]))
    windows = F.sort_array(
        F.transform(
            starts,
            lambda at: F.struct(F.concat_ws(" ", *[F.get(words, at + k) for k in range(WINDOW)]).alias("text"), at.alias("at")),
        )
    )

    def covered(found: Column) -> Column:
        again = F.filter(
            found,
            lambda w, k: (F.get(found, k - 1)["text"].eqNullSafe(w["text"]))
            | (F.get(found, k + 1)["text"].eqNullSafe(w["text"])),
        )
        places = F.sort_array(F.transform(again, lambda w: w["at"]))
        # each window adds what it reaches beyond the one before
        start = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda acc, at: F.struct(
                (acc["total"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("total"), at.alias("last")
            ),
            lambda acc: acc["total"],
        )

    # equal windows have equal hashes, so all-different hashes settle most texts
    several = bind(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(n < WINDOW, 0).when(several, bind(windows, covered)).otherwise(0)


def measures(text: Column) -> Column:
    """Struct of word counts and the other counts of one text."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, _BREAK), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(_WORD))

    def counted(w: Column) -> Column:
        return bind(
            F.size(w),
            lambda n: F.struct(
                n.cast("long").alias("n_words"),
                F.aggregate(w, F.lit(0).cast("long"), lambda total, x: total + F.length(x)).alias("word_chars"),
                F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                bind(lines, F.size).cast("long").alias("n_lines"),
                bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                _repeat_words(w, n).cast("long").alias("n_repeat_words"),
            ),
        )

    return bind(words, counted)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def _rule_values(m: Column) -> dict[str, Column]:
    words = F.greatest(m["n_words"], F.lit(1))
    return {
        "symbols_per_word": m["n_symbols"] / words,
        "duplicate_line_share": m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
        "repeated_word_share": m["n_repeat_words"] / words,
        "letters_per_word": m["word_chars"] / words,
    }


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(X <= k) for X binomial(n, share), summed term by term from the logarithm of the first.

    From k >= n * share on it is above 0.2 for any n, so 1 is returned there; no test may pass then.
    """
    first = F.struct((n * math.log1p(-share)).alias("log"), F.lit(0.0).alias("total"))
    odds = math.log(share) - math.log1p(-share)
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        first,
        lambda acc, j: F.struct(
            (acc["log"] + F.log((n - j) / (j + 1)) + odds).alias("log"), (acc["total"] + F.exp(acc["log"])).alias("total")
        ),
        lambda acc: acc["total"],
    )
    return F.when(k >= n * share, 1.0).otherwise(total)


def measure(docs: DataFrame, text: str = "text", stratum: str = "lang", carry: Sequence[str] | None = None) -> DataFrame:
    """``_row`` (the columns ``carry``, by default all), ``_stratum`` and ``_m`` (measures)."""
    return docs.select(
        F.struct(*(docs.columns if carry is None else carry)).alias("_row"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"),
        measures(F.col(text)).alias("_m"),
    )


def _good(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Ids (``_id``) that every label calls good."""
    worst = labels.groupBy(F.col(doc_id).alias("_id")).agg(F.min(F.coalesce(quality, F.lit(0))).alias("_good"))
    return worst.where("_good = 1").select("_id")


def fit_cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    quality: str = "quality",
    max_loss: float = MAX_LOSS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Certified cutoff of each rule (null: none) by ``_stratum``, from measured rows that carry ``doc_id``."""
    good = _good(labels, doc_id, quality)
    held = measured.select(F.col("_row")[doc_id].alias("_id"), "_stratum", "_m").join(good, "_id", "left_semi")
    values = _rule_values(F.col("_m"))
    losses = [
        F.sum((values[rule] > cutoff).cast("long")).alias(f"{rule}_{at}")
        for rule, cutoffs in CUTOFFS.items()
        for at, cutoff in enumerate(cutoffs)
    ]
    counted = held.where(~base_failed(F.col("_m"))).groupBy("_stratum").agg(F.count("*").alias("n"), *losses)
    counted = checkpointed(counted)  # one row for each stratum
    level = confidence / (max(1, counted.count()) * len(CUTOFFS))
    share = max_loss / len(CUTOFFS)

    def certified(rule: str, cutoffs: tuple[float, ...]) -> Column:
        passed = F.array(*[binomial_tail(F.col(f"{rule}_{at}"), F.col("n"), share) <= level for at in range(len(cutoffs))])
        # up to the first failure; position 0 means that none failed
        first_failure = F.array_position(passed, False)
        last = F.when(first_failure == 0, len(cutoffs)).otherwise(first_failure - 1).cast("int")
        return F.get(F.array(*map(F.lit, cutoffs)), last - 1).alias(rule)

    return counted.select("_stratum", *[certified(r, c) for r, c in CUTOFFS.items()])


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``_row``, ``_m``, ``base_failed`` and ``kept`` of measured rows.

    The table of cutoffs has one row for each stratum. It is broadcast if a count shows it small; otherwise
    it is joined by shuffle, where adaptive execution splits a hot stratum.
    """
    rules = cutoffs.select("_stratum", F.struct(*CUTOFFS).alias("_cutoffs"))
    if rules.count() <= MAX_BROADCAST_STRATA:
        rules = F.broadcast(rules)
    judged = measured.join(rules, "_stratum", "left")
    values = _rule_values(F.col("_m"))
    exceeded = [F.coalesce(values[rule] > F.col("_cutoffs")[rule], F.lit(False)) for rule in CUTOFFS]
    failed = base_failed(F.col("_m"))
    kept = ~failed
    for wrong in exceeded:
        kept = kept & ~wrong
    return judged.select("_row", "_m", failed.alias("base_failed"), kept.alias("kept"))


def keep_documents(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    All texts are measured once for the verdicts, and those that are labelled good once more for the cutoffs; these are
    found by a broadcast of the good ids behind a count, so no text is shuffled (beyond it all are measured twice).
    """
    good = checkpointed(_good(labels))
    held = docs
    if good.count() <= MAX_BROADCAST_IDS:
        held = docs.join(F.broadcast(good), docs[doc_id] == good["_id"], "left_semi")
    cutoffs = fit_cutoffs(measure(held, text, stratum, [doc_id]), labels, doc_id)
    judged = judge(measure(docs, text, stratum), cutoffs).select("_row", F.array("kept").alias("kept"))
    # as a generated row: a filter on the column would be pushed down and measure every text again
    passed = judged.select("_row", F.explode("kept").alias("kept")).where("kept")
    return passed.select("_row.*")
