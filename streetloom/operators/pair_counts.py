"""Numbers of pairs within a distance by groups of both sides, without making the pairs.

Both tables are dealt to tasks by grid cells some radii wide. Within a cell the left points lie in small blocks: a
right point that is near enough to, or too far from, all points of a block is settled for the block at once, and only
those in between are compared point by point. So the work grows with the rows and the rims of the circles, not with
the pairs. Distances here are chords of the unit sphere; the few pairs too close to the radius for them to decide are
handed on with their coordinates and decided by the distance of ``radius_join``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from streetloom.fixed_values import EARTH_RADIUS_M, RADIUS_M
from streetloom.functions.geo import haversine_m
from streetloom.operators.radius import MARGIN, band, cells_in_band, chord, on_sphere, own_cell
from streetloom.operators.skew import salted_sides
from streetloom.session import ship_sources

CELL_RADII = 4  # width of a cell
HOT_CELL_ROWS = 200_000  # a cell with more rows on a side is cut into parts
ROWS_PER_TASK = 300_000
CANDIDATES_PER_BUCKET = 20_000_000  # rows of both sides of its cells multiplied; a bucket is compared and returned at once
BUCKETS_PER_CELL = 4  # beyond, more buckets part no more cells
BLOCK_ROWS = 32
MAX_BLOCKS = 128  # along a side of a cell
SMALL_CELL = 20_000  # candidates; cells of fewer are compared many at a time
CHUNK = 1_000_000  # numbers in a matrix
MAX_TOTALS = 4_000_000  # numbers in the matrix of a cell's counts, and counts kept before they are summed

_AXES = ("_x", "_y", "_z")
_AT = ("_left_lat", "_left_lon", "_right_lat", "_right_lon")


def cells_touched(lat: str, lon: str, radius_m: float, cell_m: float) -> Column:
    """Array of the cells of width ``cell_m`` that points within the radius may lie in, each once."""
    reach = math.degrees(radius_m / EARTH_RADIUS_M) * MARGIN
    half = math.sin(min(radius_m / EARTH_RADIUS_M / 2, math.pi / 2))
    beside = f"(degrees(asin(least(1D, {half}D / greatest(cos(radians(least(90D, abs(`{lat}`) + {reach}D))), 1e-12D)))) * {2 * MARGIN}D)"

    def slot(side: str) -> str:
        return f"floor((`{lon}` {side} {beside} + 180D) / 360D * n)"

    slots = f"transform(sequence({slot('-')}, least({slot('+')}, {slot('-')} + n - 1)), s -> named_struct('cy', cy, 'cx', pmod(s, n)))"
    with_count = f"flatten(transform(array({cells_in_band('cy', cell_m)}), n -> {slots}))"
    bands = f"sequence({band(f'(`{lat}` - {reach}D)', cell_m)}, {band(f'(`{lat}` + {reach}D)', cell_m)})"
    return F.expr(f"flatten(transform({bands}, cy -> {with_count}))")


def _located(df: DataFrame, by: Sequence[str], at: tuple[str, str], side: str) -> DataFrame:
    """Group columns, their text as ``_key``, coordinates and the place on the sphere of rows that have one."""
    lat, lon = (F.col(name) for name in at)
    placed = df.where(lat.isNotNull() & lon.isNotNull()).select(
        *by,
        F.to_json(F.struct(*[F.col(name) for name in by])).alias("_key") if by else F.lit("").alias("_key"),
        lat.alias(f"_{side}_lat"),
        lon.alias(f"_{side}_lon"),
        *[value.alias(axis) for axis, value in zip(_AXES, on_sphere(lat, lon), strict=True)],
    )
    return placed.where(~F.isnan(F.col("_x") + F.col("_y") + F.col("_z")))


def _groups(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Group of every row, and a row of every group."""
    codes = table.column("_key").combine_chunks().dictionary_encode().indices.to_numpy()
    return codes, np.unique(codes, return_index=True)[1]


def _points(table: pa.Table) -> np.ndarray:
    return np.stack([table.column(axis).to_numpy() for axis in _AXES], axis=1)


def _cells(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A number for the cell, and the part of it, of every row of both tables."""
    code = np.zeros(len(left) + len(right), np.int64)
    for name in ("cy", "cx", "_left_part", "_right_part"):
        if name in left.column_names:
            both = np.concatenate([left.column(name).to_numpy(), right.column(name).to_numpy()])
            at = np.unique(both, return_inverse=True)[1]
            code = np.unique(code * (at.max() + 1) + at, return_inverse=True)[1]
    return code[: len(left)], code[len(left) :]


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


class _Count:
    """Counts by pair of group codes, and pairs of rows that are left to be decided."""

    def __init__(self, radius_m: float, right_groups: int):
        self.reach, self.right_groups = chord(radius_m), right_groups
        self.sure = max(0.0, self.reach - 1e-13) ** 2 * (1 - 1e-9)
        self.maybe = (self.reach + 1e-13) ** 2 * (1 + 1e-9)
        self.codes, self.counts, self.open = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        self.held, self.summed = 0, 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes.append(codes)
        self.counts.append(counts.astype(np.int64))
        self.held += len(codes)
        if self.held > max(MAX_TOTALS, 2 * self.summed):
            codes, counts = self.totals()
            self.codes, self.counts, self.held, self.summed = [codes], [counts], len(codes), len(codes)

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        codes, counts = np.concatenate(self.codes), np.concatenate(self.counts)
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        starts = _runs(codes) if len(codes) else np.zeros(0, np.int64)
        return codes[starts], np.add.reduceat(counts, starts) if len(codes) else counts

    def small(self, q, b, of_q, of_b, rows_q, rows_b) -> None:
        """Candidates (rows_q[i], rows_b[i])."""
        apart = ((q[rows_q] - b[rows_b]) ** 2).sum(axis=1)
        inside = apart <= self.sure
        self.add(*np.unique(of_q[rows_q[inside]] * self.right_groups + of_b[rows_b[inside]], return_counts=True))
        between = ~inside & (apart <= self.maybe)
        self.open.append((rows_q[between], rows_b[between]))

    def dense(self, q, b, of_q, of_b, rows_q, rows_b) -> None:
        """All rows_q with all rows_b, which lie in one cell."""
        rows_b = rows_b[np.argsort(of_b[rows_b], kind="stable")]
        middle = b[rows_b].mean(axis=0)
        b, q = b[rows_b] - middle, q[rows_q] - middle
        groups_b = of_b[rows_b]
        starts_b = _runs(groups_b)
        names_b, run_b = groups_b[starts_b], np.repeat(np.arange(len(starts_b)), np.diff([*starts_b, len(groups_b)]))
        # blocks by the two directions in which the points lie apart most
        flat = (q - q.mean(axis=0)) @ np.linalg.eigh(np.cov(q.T) if len(q) > 1 else np.eye(3))[1][:, 1:]
        sides = int(np.clip(math.sqrt(len(q) / BLOCK_ROWS), 1, MAX_BLOCKS))
        span = np.maximum(np.ptp(flat, axis=0), 1e-300)
        block = (np.minimum((flat - flat.min(axis=0)) / span * sides, sides - 1).astype(np.int64) * [sides, 1]).sum(axis=1)
        order = np.lexsort((of_q[rows_q], block))
        q, rows_q, block = q[order], rows_q[order], block[order]
        starts = _runs(block)
        ends = np.append(starts[1:], len(block))
        centre = np.add.reduceat(q, starts) / (ends - starts)[:, None]
        width = np.sqrt(np.maximum.reduceat(((q - np.repeat(centre, ends - starts, axis=0)) ** 2).sum(axis=1), starts))
        q_sq, b_sq = (q**2).sum(axis=1), (b**2).sum(axis=1)
        slack = 1e-14 * (q_sq.max() + b_sq.max())
        names_q, run_q = np.unique(of_q[rows_q], return_inverse=True)
        at_once = len(names_q) * len(names_b) <= MAX_TOTALS
        total = np.zeros((len(names_q), len(names_b)) if at_once else (0, 0))
        at = 0
        while at < len(starts):  # some blocks at a time, for the sake of memory
            rows = max(1, CHUNK // max(len(b), 1))
            to = at + 1
            while to < len(starts) and to - at < rows and ends[to] - starts[at] <= max(BLOCK_ROWS, CHUNK // len(names_b)):
                to += 1
            if not at_once:
                names_q, run_q = np.unique(of_q[rows_q[starts[at] : ends[to - 1]]], return_inverse=True)
                total = np.zeros((len(names_q), len(names_b)))
            before = 0 if at_once else starts[at]
            part = slice(at, to)
            far = np.sqrt(np.maximum(0.0, (centre[part] ** 2).sum(axis=1)[:, None] + b_sq - 2 * centre[part] @ b.T))
            # errors of the matrix are far below a millionth of the radius or of the cell
            loose = 1e-6 * self.reach + 1e-7 * math.sqrt(q_sq.max() + b_sq.max())
            whole = far + width[part, None] <= self.reach - loose
            rim = ~whole & (far - width[part, None] <= self.reach + loose)
            whole = np.add.reduceat(whole, starts_b, axis=1, dtype=np.float64)
            for k in range(at, to):
                here = slice(starts[k], ends[k])
                own = run_q[starts[k] - before : ends[k] - before]
                first = _runs(own)  # a block's rows are in order of their groups
                some, sizes = own[first], np.diff([*first, len(own)])
                total[some] += sizes[:, None] * whole[k - at]
                near = np.flatnonzero(rim[k - at])
                if not len(near):
                    continue
                apart = q_sq[here, None] + b_sq[near] - 2 * q[here] @ b[near].T
                inside = apart <= self.sure - slack
                between = ~inside & (apart <= self.maybe + slack)
                if between.any():
                    left, right = np.nonzero(between)
                    self.open.append((rows_q[starts[k] + left], rows_b[near[right]]))
                runs = _runs(run_b[near])
                found = np.add.reduceat(np.add.reduceat(inside, first, axis=0, dtype=np.float64), runs, axis=1)
                total[np.ix_(some, run_b[near[runs]])] += found
            if not at_once or to == len(starts):
                some_q, some_b = np.nonzero(total)
                self.add(names_q[some_q] * self.right_groups + names_b[some_b], total[some_q, some_b])
            at = to


def _count_task(left: pa.Table, right: pa.Table, radius_m: float, by_left: Sequence[str], by_right: Sequence[str], schema: pa.Schema) -> pa.Table:
    if not len(left) or not len(right):
        return schema.empty_table()
    (of_q, row_q), (of_b, row_b) = _groups(left), _groups(right)
    q, b = _points(left), _points(right)
    of_q = of_q.astype(np.int64)
    count = _Count(radius_m, len(row_b))
    cell_q, cell_b = _cells(left, right)
    by_q, by_b = np.argsort(cell_q, kind="stable"), np.argsort(cell_b, kind="stable")
    cells = np.intersect1d(cell_q, cell_b)
    from_q, to_q = (np.searchsorted(cell_q[by_q], cells, side) for side in ("left", "right"))
    from_b, to_b = (np.searchsorted(cell_b[by_b], cells, side) for side in ("left", "right"))
    candidates = (to_q - from_q) * (to_b - from_b)
    for k in np.flatnonzero(candidates > SMALL_CELL):
        count.dense(q, b, of_q, of_b, by_q[from_q[k] : to_q[k]], by_b[from_b[k] : to_b[k]])
    small = np.flatnonzero(candidates <= SMALL_CELL)
    edges = np.cumsum(candidates[small]) // CHUNK
    for chunk in np.split(small, _runs(edges)[1:]) if len(small) else []:
        n = candidates[chunk]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        wide = np.repeat((to_b - from_b)[chunk], n)
        count.small(
            q, b, of_q, of_b, by_q[np.repeat(from_q[chunk], n) + place // wide], by_b[np.repeat(from_b[chunk], n) + place % wide]
        )
    codes, counts = count.totals()
    open_q, open_b = (np.concatenate([pair[i] for pair in count.open] or [np.zeros(0, np.int64)]).astype(np.int64) for i in (0, 1))
    take_q = np.concatenate([row_q[codes // len(row_b)], open_q])
    take_b = np.concatenate([row_b[codes % len(row_b)], open_b])
    undecided = np.arange(len(take_q)) >= len(codes)
    columns = [*(left.column(name).take(pa.array(take_q)) for name in by_left), *(right.column(name).take(pa.array(take_b)) for name in by_right)]
    columns.append(pa.array(np.concatenate([counts, np.ones(len(open_q), np.int64)])))
    for name in _AT:
        table, take = (left, take_q) if "left" in name else (right, take_b)
        columns.append(pa.array(table.column(name).to_numpy()[take], mask=~undecided))
    return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema.names)


def pair_counts(
    left: DataFrame,
    right: DataFrame,
    by_left: Sequence[str],
    by_right: Sequence[str],
    radius_m: float = RADIUS_M,
    left_at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("latitude", "longitude"),
    name: str = "n_pairs",
    hot_cell_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Groups of ``radius_join`` pairs by columns of both sides, and their number as ``name``.

    A group may come in several rows, to be summed: one for each task that has some of its pairs. Give the smaller
    table as ``right``, whose rows go to every cell that they reach. Cells with many rows are cut into parts. Counting
    the rows by cell runs when called.
    """
    cell_m = CELL_RADII * radius_m
    stay = _located(left, by_left, left_at, "left").withColumn("_cell", own_cell("_left_lat", "_left_lon", cell_m))
    move = _located(right, by_right, right_at, "right").withColumn(
        "_cell", F.explode(cells_touched("_right_lat", "_right_lon", radius_m, cell_m))
    )
    stay, move = (side.select("*", "_cell.cy", "_cell.cx").drop("_cell") for side in (stay, move))
    identity = ["_key", "_x", "_y", "_z"]
    # copies of a row lie in one part, so parts are cut by a row number too
    stay, move = (side.withColumn("_row", F.monotonically_increasing_id()) for side in (stay, move))
    stay, move, keys, rows, candidates, cells = salted_sides(stay, move, ["cy", "cx"], hot_cell_rows, [*identity, "_row"], [*identity, "_row"])
    tasks = max(left.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))
    # a bucket is in memory as a whole, with its counts, so cells of many candidates should not share one
    buckets = max(tasks, min(math.ceil(candidates / CANDIDATES_PER_BUCKET), BUCKETS_PER_CELL * cells))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_task")
    stay = stay.drop("_row", "_beyond").select("*", bucket).repartition(tasks, "_task")
    move = move.drop("_row", "_beyond").select("*", bucket).repartition(tasks, "_task")
    fields = [*stay.select(*by_left).schema, *move.select(*by_right).schema, T.StructField(name, T.LongType())]
    out = T.StructType([*fields, *[T.StructField(at, T.DoubleType()) for at in _AT]])
    arrow, of_left, of_right = to_arrow_schema(out), list(by_left), list(by_right)

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        return _count_task(one, other, radius_m, of_left, of_right, arrow)

    ship_sources(left.sparkSession)
    counted = stay.groupBy("_task").cogroup(move.groupBy("_task")).applyInArrow(run, out)
    near = haversine_m(*[F.col(at) for at in _AT]) <= float(radius_m)
    return counted.where(F.col(_AT[0]).isNull() | near).drop(*_AT)
