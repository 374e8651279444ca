"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetloom.session import checkpointed


def number_rows(df: DataFrame, group: str | Sequence[str], order_by: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: 1..n within ``group``, one column or several; a group is sorted by one task."""
    groups = [group] if isinstance(group, str) else list(group)
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by)))


def number_rows_by_ranges(df: DataFrame, group: str, order_by: Sequence[Column], name: str) -> DataFrame:
    """Like ``number_rows`` for groups that no single task should sort, nulls being one; ``order_by`` must end uniquely.

    Rows are cut into ranges of (group, order), so a large group lies in several ranges one after the
    other. A row's number is its number within the range plus the group's rows in earlier ranges. The
    ranges are checkpointed with the rows, which keeps them the same for both steps.
    """
    ranged = checkpointed(
        df.repartitionByRange(F.col(group), *order_by).withColumn("_range", F.spark_partition_id())
    )
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        ranged.groupBy(group, "_range")
        .agg(F.count("*").alias("_n"))
        .select(F.col(group).alias("_group"), F.col("_range").alias("_of"), F.coalesce(before, F.lit(0)).alias("_before"))  # one row per range
    )
    within = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order_by))
    return (
        ranged.withColumn(name, within)
        .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
        .withColumn(name, (F.col(name) + F.col("_before")).cast("int"))
        .drop("_range", "_before", "_group", "_of")
    )
