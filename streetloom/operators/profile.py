"""Table profiles and stage audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _missing(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    return col.isNull() | F.isnan(col) if dict(df.dtypes)[name] in ("double", "float") else col.isNull()


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, pct) for columns with missing values, in one pass over the table."""
    names = df.columns
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(_missing(df, name)).alias(name) for name in names]
    )
    return (
        counts.unpivot(["_rows"], names, "column", "nulls")
        .where(F.col("nulls") > 0)
        .select("column", "nulls", (100 * F.col("nulls") / F.col("_rows")).alias("pct"))
    )


def table_profile(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """(position, column, type, rows, first_value): shape, types and the first record in ``order_by``."""
    names = df.columns
    first = F.min_by(F.struct(*[F.col(n).cast("string").alias(n) for n in names]), F.struct(*order_by))
    summary = df.agg(F.count("*").alias("rows"), first.alias("first"))
    described = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.lit(kind).alias("type"),
                F.col("rows"),
                F.col(f"first.{name}").alias("first_value"),
            )
            for position, (name, kind) in enumerate(df.dtypes, start=1)
        ]
    )
    return summary.select(F.inline(described))


def stage_audit(counts: DataFrame, stages: Sequence[str]) -> DataFrame:
    """(step, stage, rows_in, rows_out, dropped, pct_kept) from one row of counts.

    ``counts`` has one column per stage in order; the first is the input.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(step).alias("step"),
                F.lit(stage).alias("stage"),
                F.col(before).alias("rows_in"),
                F.col(stage).alias("rows_out"),
                (F.col(before) - F.col(stage)).alias("dropped"),
                F.when(F.col(before) > 0, F.round(100 * F.col(stage) / F.col(before), 2)).alias("pct_kept"),
            )
            for step, (before, stage) in enumerate(zip(stages, stages[1:]), start=1)
        ]
    )
    return counts.select(F.inline(rows))


def metrics_table(counts: DataFrame, stage: str) -> DataFrame:
    """One row of numbers as (stage, metric, value)."""
    return counts.select(*[F.col(n).cast("double").alias(n) for n in counts.columns]).unpivot(
        [], counts.columns, "metric", "value"
    ).select(F.lit(stage).alias("stage"), "metric", "value")
