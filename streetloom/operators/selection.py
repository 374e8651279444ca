"""Exact order statistics of whole-number columns without a buffer of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGES = 4_096  # into which the values are counted at a time


def value_at(df: DataFrame, column: str, rank: int, low: int, high: int, ranges: int = RANGES) -> int:
    """The value with ``rank`` rows before it in ascending order; all values lie in ``low`` .. ``high``.

    Rows are counted by equal ranges of values, and the one that holds the rank is cut anew until it is a single value:
    at most log(high - low) / log(ranges) passes, each of which exchanges and returns at most ``ranges`` counts a task.
    """
    while low < high:
        width = -(-(high - low + 1) // ranges)
        at = F.expr(f"cast((cast(`{column}` as decimal(20)) - {low}) div {width} as long)")  # no overflow at the ends of long
        counted = df.where(F.col(column).between(low, high)).groupBy(at.alias("at")).count()
        for row in sorted(counted.collect(), key=lambda r: r["at"]):
            if rank < row["count"]:
                low, high = low + row["at"] * width, min(high, low + (row["at"] + 1) * width - 1)
                break
            rank -= row["count"]
    return low


def exact_median(df: DataFrame, column: str, ranges: int = RANGES) -> float | None:
    """Median of a whole-number column, nulls left out; None without values. Runs when called.

    ``df`` is read a few times: give it stored.
    """
    n, low, high = df.agg(F.count(column), F.min(column), F.max(column)).first()
    if not n:
        return None
    below = value_at(df, column, (n - 1) // 2, low, high, ranges)
    if n % 2:
        return float(below)
    return (below + value_at(df, column, n // 2, low, high, ranges)) / 2
