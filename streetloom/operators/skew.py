"""Equality joins whose hot keys are cut into parts."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.session import checkpointed

# Above this many hot keys their table is joined without the broadcast hint.
MAX_BROADCAST_KEYS = 1_000_000


def hot_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], limit: int, pair_limit: int | None = None
) -> DataFrame:
    """Keys with more than ``limit`` rows on a side or ``pair_limit`` pairs, and the parts each side is cut into.

    ``pair_limit`` defaults to ``limit`` squared. A left and a right part have at most about ``limit`` rows each and
    ``pair_limit`` pairs together: the smaller side is cut to the square root of it at most, the larger side to
    what is left. Counted after a map-side sum of both sides together. At most (rows of both sides) /
    least(limit, sqrt(pair_limit)) keys come out.
    """
    return _hot(_key_counts(left, right, keys), keys, limit, pair_limit)


def _key_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each side by key: l and r."""
    marks = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return marks.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))


def _pairs_of(limit: int, pair_limit: int | None) -> float:
    return float(limit) ** 2 if pair_limit is None else float(pair_limit)


def _is_hot(limit: int, pairs: float) -> Column:
    return (F.col("l") > limit) | (F.col("r") > limit) | (F.col("l").cast("double") * F.col("r") > pairs)


def _hot(counts: DataFrame, keys: Sequence[str], limit: int, pair_limit: int | None) -> DataFrame:
    pairs = _pairs_of(limit, pair_limit)
    rows_small, rows_large = F.least("l", "r"), F.greatest("l", "r")
    small_parts = F.greatest(F.lit(1.0), F.ceil(rows_small / min(float(limit), pairs**0.5)))
    reach = F.least(F.lit(float(limit)), pairs / F.greatest(F.lit(1.0), rows_small / small_parts))
    large_parts = F.greatest(F.lit(1.0), F.ceil(rows_large / F.greatest(F.lit(1.0), reach)))
    return (
        counts.where(_is_hot(limit, pairs))
        .select(
            *keys,
            F.when(F.col("l") <= F.col("r"), small_parts).otherwise(large_parts).cast("int").alias("left_parts"),
            F.when(F.col("l") <= F.col("r"), large_parts).otherwise(small_parts).cast("int").alias("right_parts"),
        )
    )


def _in_parts(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], spread_by: Sequence[str], own: str, other: str
) -> DataFrame:
    """Each row gets one part of its own side, by hash, and is repeated for the other side's parts."""
    part = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col(f"{own}_parts"), F.lit(1))).cast("int")
    parts_beyond = F.coalesce(F.col(f"{other}_parts"), F.lit(1))
    return (
        df.join(hot, list(keys), "left")
        .withColumn(f"_{own}_part", part)
        .withColumn("_beyond", parts_beyond)
        .withColumn(f"_{other}_part", F.explode(F.sequence(F.lit(0), parts_beyond - 1)))
        .drop("left_parts", "right_parts")
    )


def salted_sides(
    left: DataFrame, right: DataFrame, keys: Sequence[str], limit: int, left_id: Sequence[str], right_id: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str], int, float, int]:
    """Both sides of a join on ``keys`` with hot keys cut into parts, the columns it is then on, the rows of both, their pairs
    and the number of keys that have some.

    Counts the rows per key when called; as in ``salted_join`` every pair of rows still meets exactly once.
    """
    counts = _key_counts(left, right, keys)
    pairs = F.col("l").cast("double") * F.col("r")
    n_hot, rows, candidates, met = counts.agg(
        F.count_if(_is_hot(limit, _pairs_of(limit, None))), F.coalesce(F.sum(F.col("l") + F.col("r")), F.lit(0)),
        F.coalesce(F.sum(pairs), F.lit(0.0)), F.count_if(pairs > 0),
    ).first()
    if not n_hot:
        return left, right, list(keys), rows, candidates, met
    hot = checkpointed(_hot(counts, keys, limit, None))
    placed = F.broadcast(hot) if n_hot <= MAX_BROADCAST_KEYS else hot
    left = _in_parts(left, placed, keys, left_id, "left", "right").drop("_beyond")
    right = _in_parts(right, placed, keys, right_id, "right", "left").drop("_beyond")
    return left, right, [*keys, "_left_part", "_right_part"], rows, candidates, met


def left_in_parts(
    left: DataFrame, right: DataFrame, keys: Sequence[str], limit: int, pair_limit: int, right_limit: int, left_id: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str], int, float] | None:
    """Like ``salted_sides``, but only the left side of a hot key is cut, so that a left row meets all of its pairs in one part.

    A part has at most about ``limit`` left rows and ``pair_limit`` pairs; rows of the left side that are equal in ``left_id``
    stay in one. Also gives all pairs. None if a key has more than ``right_limit`` rows on the right. Runs when called.
    """
    counts = _key_counts(left, right, keys).withColumn("pairs", F.col("l").cast("double") * F.col("r"))
    is_hot = ((F.col("l") > limit) | (F.col("pairs") > pair_limit)) & (F.col("r") > 0)
    n_hot, rows, pairs, most = counts.agg(
        F.count_if(is_hot), F.coalesce(F.sum(F.col("l") + F.col("r")), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0.0)),
        F.coalesce(F.max(F.when(F.col("l") > 0, F.col("r"))), F.lit(0)),
    ).first()
    if most > right_limit:
        return None
    if not n_hot:
        return left, right, list(keys), rows, pairs
    parts = F.least(F.col("l"), F.ceil(F.greatest(F.col("l") / float(limit), F.col("pairs") / float(pair_limit)))).cast("int")
    hot = checkpointed(counts.where(is_hot).select(*keys, parts.alias("left_parts"), F.lit(1).alias("right_parts")))
    placed = F.broadcast(hot) if n_hot <= MAX_BROADCAST_KEYS else hot
    left = _in_parts(left, placed, keys, left_id, "left", "right").drop("_beyond", "_right_part")
    right = _in_parts(right, placed, keys, keys, "right", "left").drop("_beyond", "_right_part")
    return left, right, [*keys, "_left_part"], rows, pairs


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    limit: int,
    left_id: Sequence[str],
    right_id: Sequence[str],
    condition: Column | None = None,
    how: str = "inner",
    pairs_per_task: int | None = None,
    wide: str | None = None,
    pair_limit: int | None = None,
    least_tasks: int = 1,
    keep_parts: bool = False,
    dealt: tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]] | None = None,
) -> DataFrame:
    """Join on ``keys`` in which no task gets more than about ``limit`` rows of one key per side,
    and evaluates more than about ``pair_limit`` (default: ``limit`` squared) pairs of it.

    Calling it counts the rows per key, in one pass if no key is hot. Then it is a plain join. Else a hot key is cut into
    left parts x right parts; every pair of rows still meets exactly once. ``left_id`` and ``right_id``
    name columns that tell rows of a side apart; they decide the part. With ``how='left_semi'`` a left row
    may come out once per right part.

    ``pairs_per_task`` deals the join out to as many tasks as its pairs need, for joins that do much work per
    byte and would be merged into few tasks by their size, ``least_tasks`` at least. ``keep_parts`` leaves the columns
    ``_left_part`` and ``_right_part`` of a join with hot keys. ``wide`` names a column, added only if there are hot keys, that is true for
    left rows whose key is cut on the right; other rows have at most ``limit`` matches. ``dealt`` holds a step for each side
    that adds columns to its rows once they lie in tasks, so that these are not sent.
    """
    counts = _key_counts(left, right, keys)
    n_hot, pairs = counts.agg(
        F.count_if(_is_hot(limit, _pairs_of(limit, pair_limit))), F.coalesce(F.sum(F.col("l").cast("double") * F.col("r")), F.lit(0.0))
    ).first()
    by = list(keys)
    if n_hot:
        hot = checkpointed(_hot(counts, keys, limit, pair_limit))
        placed = F.broadcast(hot) if n_hot <= MAX_BROADCAST_KEYS else hot
        left = _in_parts(left, placed, keys, left_id, "left", "right")
        right = _in_parts(right, placed, keys, right_id, "right", "left").drop("_beyond")
        if wide is not None:
            left = left.withColumn(wide, F.col("_beyond") > 1)
        left = left.drop("_beyond")
        by += ["_left_part", "_right_part"]
    if pairs_per_task is not None:
        tasks = max(least_tasks, math.ceil(pairs / pairs_per_task))
        left, right = left.repartition(tasks, *by), right.repartition(tasks, *by)
    if dealt is not None:
        left, right = dealt[0](left), dealt[1](right)
    right = right.withColumnsRenamed({name: f"_r{name}" for name in by})
    on = condition
    for name in by:
        same = F.col(name) == F.col(f"_r{name}")
        on = same if on is None else on & same
    dropped = [*([] if keep_parts else ["_left_part", "_right_part"]), *([f"_r{name}" for name in by] if how == "inner" else [])]
    return left.join(right, on, how).drop(*dropped)
