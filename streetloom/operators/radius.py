"""Radius join: all pairs of two point tables within a distance, as an equality join on grid cells."""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.fixed_values import EARTH_RADIUS_M, RADIUS_M
from streetloom.functions.geo import haversine_m
from streetloom.operators.skew import salted_join

# A cell above this many rows on either side is cut into parts of about this size.
HOT_CELL_ROWS = 1_000_000
# Nor does a task evaluate more than about this many candidates of one cell.
HOT_CELL_PAIRS = 500_000_000
# Candidates for each task, so that what a task sorts of its pairs stays in memory.
PAIRS_PER_TASK = 2_000_000
# Columns that deal the pairs out to tasks, those of them that the join has.
CELL = ("cy", "cx", "_left_part", "_right_part")

MARGIN = 1.0001  # keeps rounding of the cell arithmetic on the safe side


def _band_height(radius_m: float) -> float:
    return min(180.0, math.degrees(radius_m / EARTH_RADIUS_M) * MARGIN)


def cells_in_band(at: str, radius_m: float) -> str:
    """SQL for the number of equal cells around the globe in a latitude band.

    A cell is at least as wide as the largest longitude difference of two points within the radius,
    one in this band and one in it or its neighbours: sin(dlon/2) <= sin(angle/2) / cos(lat).
    """
    height = _band_height(radius_m)
    south = f"abs({at} * {height}D - {90 + height}D)"
    north = f"abs({at} * {height}D - {90 - 2 * height}D)"
    steepest = f"least(90D, greatest({south}, {north}))"
    half_angle = min(radius_m / EARTH_RADIUS_M / 2, math.pi / 2)
    reach = f"{math.sin(half_angle)}D / greatest(cos(radians({steepest})), 1e-12D)"
    return f"greatest(1L, floor(360D / (degrees(asin(least(1D, {reach}))) * {2 * MARGIN}D)))"


def band(lat: str, radius_m: float) -> str:
    """SQL for the latitude band of an SQL expression."""
    return f"floor(({lat} + 90D) / {_band_height(radius_m)}D)"


def _slot(lon: str, cells: str) -> str:
    return f"floor((`{lon}` + 180D) / 360D * {cells})"


def own_cell(lat: str, lon: str, radius_m: float) -> Column:
    """The one cell of a point: struct(cy, cx)."""
    own = band(f"`{lat}`", radius_m)
    cells = cells_in_band(own, radius_m)
    return F.expr(f"named_struct('cy', {own}, 'cx', pmod({_slot(lon, cells)}, {cells}))")


def reachable_cells(lat: str, lon: str, radius_m: float) -> Column:
    """Array of the (up to nine) cells whose points may lie within the radius, each once."""
    own = band(f"`{lat}`", radius_m)
    slots = f"array_distinct(transform(array(-1L, 0L, 1L), step -> pmod({_slot(lon, 'n')} + step, n)))"
    in_band = f"transform({slots}, cx -> named_struct('cy', cy, 'cx', cx))"
    with_count = f"flatten(transform(array({cells_in_band('cy', radius_m)}), n -> {in_band}))"
    return F.expr(f"flatten(transform(array({own} - 1, {own}, {own} + 1), cy -> {with_count}))")


def on_sphere(lat: Column, lon: Column) -> list[Column]:
    """The point on the unit sphere."""
    return [F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))]


def chord(radius_m: float) -> float:
    """Straight distance of two points of the unit sphere that are ``radius_m`` apart on it."""
    return 2 * math.sin(min(radius_m / EARTH_RADIUS_M / 2, math.pi / 2))


def _placed(df: DataFrame, at: tuple[str, str], side: str) -> DataFrame:
    points = zip("xyz", on_sphere(F.col(at[0]), F.col(at[1])), strict=True)
    return df.withColumns({f"_{side}{axis}": value for axis, value in points})


def _about_within(radius_m: float) -> Column:
    """No pair within the radius fails it; without angles it is cheaper than the distance, so it goes first."""
    apart = sum(((F.col(f"_l{axis}") - F.col(f"_r{axis}")) * (F.col(f"_l{axis}") - F.col(f"_r{axis}")) for axis in "xyz"), F.lit(0.0))
    return apart <= (chord(radius_m) + 1e-13) ** 2 * (1 + 1e-9)


def radius_join(
    left: DataFrame,
    right: DataFrame,
    radius_m: float = RADIUS_M,
    left_at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("latitude", "longitude"),
    hot_cell_rows: int | None = HOT_CELL_ROWS,
    wide: str | None = None,
    hot_cell_pairs: int = HOT_CELL_PAIRS,
    keep_cell: bool = False,
) -> DataFrame:
    """Columns of both sides plus ``distance`` in metres, for every pair with distance <= radius.

    Column names of the two sides must differ. Give the smaller table as ``right``: it is sent to the
    nine cells around each point, while a left row stays in its own cell, so a pair meets exactly once.
    Works on the whole globe, across the date line and at the poles. Rows without coordinates match nothing.

    Cells with more than ``hot_cell_rows`` rows on a side or ``hot_cell_pairs`` candidates are cut into parts (left parts x right parts),
    so no task gets an unbounded group; ``None`` leaves skew to adaptive execution. ``wide`` names a column,
    added only if there are such cells, that is false for left rows with at most ``hot_cell_rows`` matches.
    ``keep_cell`` leaves the columns of ``CELL``, by which the pairs lie in tasks: a window over them and a
    left row's key needs no exchange.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    left_lat, left_lon = (F.col(name) for name in left_at)
    right_lat, right_lon = (F.col(name) for name in right_at)
    celled_left = (
        left.where(left_lat.isNotNull() & left_lon.isNotNull())
        .withColumn("_cell", own_cell(*left_at, radius_m))
        .select("*", "_cell.cy", "_cell.cx")
        .drop("_cell")
    )
    celled_right = (
        right.where(right_lat.isNotNull() & right_lon.isNotNull())
        .withColumn("_cell", F.explode(reachable_cells(*right_at, radius_m)))
        .select("*", "_cell.cy", "_cell.cx")
        .drop("_cell")
    )
    on_left, on_right = partial(_placed, at=left_at, side="l"), partial(_placed, at=right_at, side="r")
    if hot_cell_rows is None:
        met = on_left(celled_left).join(on_right(celled_right), ["cy", "cx"])
    else:
        met = salted_join(
            celled_left, celled_right, ["cy", "cx"], hot_cell_rows,
            left_id=left.columns, right_id=right.columns,
            wide=wide,
            pair_limit=min(hot_cell_rows**2, hot_cell_pairs),
            pairs_per_task=PAIRS_PER_TASK,
            least_tasks=left.sparkSession.sparkContext.defaultParallelism,
            keep_parts=keep_cell,
            dealt=(on_left, on_right),
        )
    if not keep_cell:
        met = met.drop("cy", "cx")
    return (
        met.where(_about_within(radius_m))
        .drop(*[f"_{side}{axis}" for side in "lr" for axis in "xyz"])
        .withColumn("distance", haversine_m(left_lat, left_lon, right_lat, right_lon))
        .where(F.col("distance") <= float(radius_m))
    )
