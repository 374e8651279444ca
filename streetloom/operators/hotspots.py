"""Spatial bins: hexagons over the data's extent and a fixed square grid."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.functions.rounding import half_even


def _limits(points: DataFrame) -> Column:
    """Least and greatest x and y as one scalar struct."""
    ends = F.struct(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    return points.agg(ends.alias("ends")).scalar()


def _start_and_step(low: Column, high: Column, cells: int) -> tuple[Column, Column]:
    """Start and cell size of an axis: slightly widened, and opened up if all values are equal."""
    slack = F.when(low != high, 0.0).when(low == 0, 0.1).otherwise(F.abs(low) * 0.1)
    low, high = low - slack, high + slack
    padding = (high - low) * 1e-9
    return low - padding, (high - low + 2 * padding) / cells


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 50, mincnt: int = 1) -> DataFrame:
    """Points per hexagon: (lattice, ix, iy, center_x, center_y, n).

    Hexagon centres form two rectangular lattices, the second moved by half a cell; a point belongs to
    the nearer centre under dx^2 + 3 dy^2 in cell units.
    """
    rows = int(gridsize / math.sqrt(3))
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop("any")
    ends = F.col("_ends")
    x0, sx = _start_and_step(ends["x0"], ends["x1"], gridsize)
    y0, sy = _start_and_step(ends["y0"], ends["y1"], rows)
    placed = (
        points.withColumn("_ends", _limits(points))
        .select(x0.alias("x0"), y0.alias("y0"), sx.alias("sx"), sy.alias("sy"), "x", "y")
        .withColumn("u", (F.col("x") - F.col("x0")) / F.col("sx"))
        .withColumn("v", (F.col("y") - F.col("y0")) / F.col("sy"))
    )
    u, v = F.col("u"), F.col("v")
    to_first = F.pow(u - F.rint(u), 2) + 3 * F.pow(v - F.rint(v), 2)
    to_second = F.pow(u - F.floor(u) - 0.5, 2) + 3 * F.pow(v - F.floor(v) - 0.5, 2)
    first = to_first < to_second
    shift = F.when(F.col("lattice") == 1, 0.0).otherwise(0.5)
    return (
        placed.select(
            "x0", "y0", "sx", "sy",
            F.when(first, 1).otherwise(2).alias("lattice"),
            F.when(first, F.rint(u)).otherwise(F.floor(u)).cast("int").alias("ix"),
            F.when(first, F.rint(v)).otherwise(F.floor(v)).cast("int").alias("iy"),
        )
        .groupBy("lattice", "ix", "iy", "x0", "y0", "sx", "sy")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= mincnt)
        .select(
            "lattice", "ix", "iy",
            ((F.col("ix") + shift) * F.col("sx") + F.col("x0")).alias("center_x"),
            ((F.col("iy") + shift) * F.col("sy") + F.col("y0")).alias("center_y"),
            "n",
        )
    )


def heat_points(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).na.drop("any")


def heat_grid(df: DataFrame, lat: str, lon: str, places: int = 3) -> DataFrame:
    """Heat points summed on a grid of ``places`` decimals."""
    points = heat_points(df, lat, lon)
    return points.groupBy(half_even(F.col("lat"), places).alias("lat"), half_even(F.col("lon"), places).alias("lon")).agg(
        F.count("*").alias("n")
    )
