"""The nearest or the best right row of every left row and its rank among all within the radius, without making the pairs.

A left row's closest match is the pair of the least rounded distance, then of the best score; pairs that rank before it are
those with a better score, so they are only counted. Both tables are dealt to tasks by grid cells some radii wide; within
a cell the left points lie in small blocks, and a block is compared with the right points around it at once. Distances
here are chords of the unit sphere. Where they leave open how the distance of ``radius_join`` rounds, and it matters,
or which of two pairs is nearer, the left row is handed on as not decided.

A left row's best match is the pair of the best score, then of the least distance. Right rows that score less than another one for
all points of a block, by their distance from its middle, are left out before points are compared.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from streetloom.fixed_values import CAT_WEIGHT, EARTH_RADIUS_M, GEO_WEIGHT, RADIUS_M
from streetloom.operators.pair_counts import cells_touched
from streetloom.operators.radius import chord, on_sphere, own_cell
from streetloom.operators.skew import left_in_parts
from streetloom.session import ship_sources

CELL_RADII = 4  # width of a cell
LEFT_ROWS = 50_000  # of a cell in one part
RIGHT_ROWS = 1_000_000  # of a cell; beyond, the rows are left to the join
CANDIDATES = 1_000_000_000  # rows of both sides of a part multiplied
CANDIDATES_PER_TASK = 250_000_000
ROWS_PER_TASK = 300_000
BUCKETS_PER_TASK = 4
BLOCK_ROWS = 64
MAX_BLOCKS = 256  # along a side of a cell
CHUNK = 1_000_000  # candidates compared at once
MAX_RADIUS_M = 40_000  # there is a table of the scores of all centimetres
MAX_SCORES = 4_000_000  # kinds multiplied by categories
SLACK = 5e-4  # scores are rounded to four places twice
TOLERANCE_M = 1e-7  # the two ways to a distance differ by less than a fifth of it

_AXES = ("_x", "_y", "_z")

Scores = Mapping[tuple[str, str], float]


def _located(df: DataFrame, at: tuple[str, str], *columns: Column) -> DataFrame:
    lat, lon = (F.col(name) for name in at)
    placed = df.where(lat.isNotNull() & lon.isNotNull()).select(
        *columns,
        lat.cast("double").alias("_lat"),
        lon.cast("double").alias("_lon"),
        *[value.alias(axis) for axis, value in zip(_AXES, on_sphere(lat, lon), strict=True)],
    )
    return placed.where(~F.isnan(F.col("_x") + F.col("_y") + F.col("_z")))


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)


class _Scoring:
    """Scores of pairs in ten-thousandths, by the arithmetic of ``matching.score_pairs``."""

    def __init__(self, scores: Scores, radius_m: float, geo_weight: float, cat_weight: float):
        self.kinds = sorted({kind for kind, _ in scores})
        self.categories = sorted({category for _, category in scores})
        self.similarity = np.zeros((len(self.kinds) + 1, len(self.categories) + 1))
        at_kind, at_category = ({name: at for at, name in enumerate(names)} for names in (self.kinds, self.categories))
        for (kind, category), score in scores.items():
            self.similarity[at_kind[kind], at_category[category]] = np.rint(score * 1e4) / 1e4
        self.weighted = self.similarity * cat_weight
        metres = np.arange(math.ceil(radius_m * 100) + 3) / 100.0
        near = np.maximum(0.0, np.minimum(1.0, 1.0 - metres / float(radius_m)))
        self.proximity = np.rint(near * 1e4) / 1e4 * geo_weight
        self.radius_m, self.reach, self.geo_weight = float(radius_m), chord(radius_m), float(geo_weight)

    def codes(self, column: pa.ChunkedArray, names: list[str]) -> np.ndarray:
        found = pc.index_in(column, value_set=pa.array(names, pa.string()))
        return pc.fill_null(found, len(names)).to_numpy().astype(np.int64)

    def hybrid(self, centimetres: np.ndarray, kinds: np.ndarray, categories: np.ndarray) -> np.ndarray:
        return np.rint((self.proximity[centimetres] + self.weighted[kinds, categories]) * 1e4)


class _Side:
    """Points, codes and places of the rows of one side."""

    def __init__(self, table: pa.Table, codes: np.ndarray):
        self.points = np.stack([table.column(axis).to_numpy() for axis in _AXES], axis=1)
        self.at = np.stack([table.column(axis).to_numpy() for axis in ("_lat", "_lon")], axis=1)
        self.codes = codes


def _pick_best(left: _Side, right: _Side, order: np.ndarray, rows_l, rows_r, apart, by: _Scoring) -> tuple[np.ndarray, ...]:
    """Like ``_pick`` for the best match of each left row, whose rank is 1."""
    d = np.arcsin(np.minimum(1.0, np.sqrt(apart) / 2)) * (2 * EARTH_RADIUS_M)
    scaled = d * 100.0
    n = np.rint(scaled).astype(np.int64)
    unsure = np.abs(scaled - n) >= 0.5 - 100 * TOLERANCE_M
    edge = np.abs(d - by.radius_m) <= TOLERANCE_M
    kinds, categories = left.codes[rows_l], right.codes[rows_r]
    hybrid = by.hybrid(n, kinds, categories)

    starts = _runs(rows_l)
    sizes = np.diff(np.append(starts, len(rows_l)))
    best = np.repeat(np.maximum.reduceat(hybrid, starts), sizes)
    tied = hybrid == best
    least = np.repeat(np.minimum.reduceat(np.where(tied, d, np.inf), starts), sizes)
    tied &= d <= least + 2 * TOLERANCE_M
    run = np.repeat(np.arange(len(starts)), sizes)
    some = np.flatnonzero(tied)
    some = some[np.lexsort((order[rows_r[some]], run[some]))]
    first = some[_runs(run[some])]
    open_rows = np.zeros(len(starts), bool)
    elsewhere = (right.at[rows_r[some]] != right.at[rows_r[first]][run[some]]).any(axis=1)
    open_rows[run[some[elsewhere]]] = True
    odd = np.flatnonzero(unsure | edge)
    low = np.floor(scaled[odd]).astype(np.int64)
    one, other = (by.hybrid(np.where(unsure[odd], c, n[odd]), kinds[odd], categories[odd]) for c in (low, low + 1))
    open_rows[run[odd[np.maximum(one, other) >= best[odd]]]] = True
    return rows_l[starts], rows_r[first], n[first], np.ones(len(starts), np.int64), ~open_rows


def _metres(chords: np.ndarray) -> np.ndarray:
    return np.arcsin(np.minimum(1.0, chords / 2)) * (2 * EARTH_RADIUS_M)


def _may_be_best(left_kinds: np.ndarray, categories: np.ndarray, away: np.ndarray, width: float, by: _Scoring) -> np.ndarray:
    """Which right rows, so far from the middle of a block, may have the best score for one of its points.

    Scores fall with the distance, so the farthest and the nearest place in the block bound them; ``SLACK`` covers their roundings.
    """
    slack_m = 0.01 + 2 * TOLERANCE_M  # a distance is rounded to centimetres
    far, near = _metres(away + width) + slack_m, np.maximum(0.0, _metres(np.maximum(0.0, away - width)) - slack_m)
    surely = far <= by.radius_m - slack_m
    kept = np.zeros(len(categories), bool)
    for kind in np.unique(left_kinds):
        weighted = by.weighted[kind, categories]
        least = np.where(surely, (1.0 - far / by.radius_m) * by.geo_weight + weighted, -np.inf).max()
        kept |= np.maximum(0.0, 1.0 - near / by.radius_m) * by.geo_weight + weighted >= least - SLACK * max(1.0, by.geo_weight)
    return kept


def _pick(left: _Side, right: _Side, order: np.ndarray, rows_l, rows_r, apart, by: _Scoring) -> tuple[np.ndarray, ...]:
    """Left rows that have pairs, and of each its closest right row, centimetres, rank and whether all that is certain.

    ``rows_l`` and ``rows_r`` are pairs in order of the left rows, ``apart`` their squared chords.
    """
    d = np.arcsin(np.minimum(1.0, np.sqrt(apart) / 2)) * (2 * EARTH_RADIUS_M)
    scaled = d * 100.0
    whole = np.rint(scaled)
    unsure = np.abs(scaled - whole) >= 0.5 - 100 * TOLERANCE_M
    edge = np.abs(d - by.radius_m) <= TOLERANCE_M
    n = whole.astype(np.int64)
    kinds, categories = left.codes[rows_l], right.codes[rows_r]
    hybrid = by.hybrid(n, kinds, categories)

    starts = _runs(rows_l)
    sizes = np.diff(np.append(starts, len(rows_l)))
    nearest = np.repeat(np.minimum.reduceat(n, starts), sizes)
    near = n == nearest
    best = np.repeat(np.maximum.reduceat(np.where(near, hybrid, -np.inf), starts), sizes)
    better = np.add.reduceat((hybrid > best).astype(np.int64), starts)
    tied = near & (hybrid == best)
    least = np.repeat(np.minimum.reduceat(np.where(tied, d, np.inf), starts), sizes)
    tied &= d <= least + 2 * TOLERANCE_M

    # the first tied pair of each row by id; other places than its own leave open which is nearer
    run = np.repeat(np.arange(len(starts)), sizes)
    some = np.flatnonzero(tied)
    some = some[np.lexsort((order[rows_r[some]], run[some]))]
    first = some[_runs(run[some])]
    open_rows = np.zeros(len(starts), bool)
    elsewhere = (right.at[rows_r[some]] != right.at[rows_r[first]][run[some]]).any(axis=1)
    open_rows[run[some[elsewhere]]] = True

    odd = np.flatnonzero(unsure | edge)
    low = np.floor(scaled[odd]).astype(np.int64)
    one, other = (by.hybrid(np.where(unsure[odd], c, n[odd]), kinds[odd], categories[odd]) for c in (low, low + 1))
    matters = ((one > best[odd]) != (other > best[odd])) | (np.where(unsure[odd], low, n[odd]) <= nearest[odd])
    matters |= edge[odd] & (np.maximum(one, other) > best[odd])
    open_rows[run[odd[matters]]] = True
    return rows_l[starts], rows_r[first], n[first], better + 1, ~open_rows


def _cell(left: _Side, right: _Side, order: np.ndarray, rows_l: np.ndarray, rows_r: np.ndarray, by: _Scoring, best: bool):
    """The picks of left rows among right rows, which lie in one cell."""
    points = left.points[rows_l]
    flat = (points - points.mean(axis=0)) @ np.linalg.eigh(np.cov(points.T) if len(points) > 1 else np.eye(3))[1][:, 1:]
    sides = int(np.clip(math.sqrt(len(points) / BLOCK_ROWS), 1, MAX_BLOCKS))
    span = np.maximum(np.ptp(flat, axis=0), 1e-300)
    block = (np.minimum((flat - flat.min(axis=0)) / span * sides, sides - 1).astype(np.int64) * [sides, 1]).sum(axis=1)
    sort = np.argsort(block, kind="stable")
    rows_l, block = rows_l[sort], block[sort]
    others = right.points[rows_r].T
    maybe = chord(by.radius_m + TOLERANCE_M / 2) ** 2
    for start, end in zip(starts := _runs(block), np.append(starts[1:], len(block))):
        points = left.points[rows_l[start:end]]
        centre = points.mean(axis=0)
        width = math.sqrt(((points - centre) ** 2).sum(axis=1).max())
        away = sum((others[axis] - centre[axis]) ** 2 for axis in range(3))
        around = np.flatnonzero(away <= (by.reach + width) ** 2 * (1 + 1e-6) + 1e-24)
        if best and by.geo_weight >= 0 and len(around):
            apart = np.sqrt(away[around])
            around = around[_may_be_best(left.codes[rows_l[start:end]], right.codes[rows_r[around]], apart, width * (1 + 1e-9), by)]
        if not len(around):
            continue
        rows, spread = max(1, CHUNK // len(around)), others[:, around]
        for at in range(0, len(points), rows):
            some = points[at : at + rows]
            apart = (some[:, :1] - spread[0]) ** 2
            for axis in (1, 2):
                step = some[:, axis : axis + 1] - spread[axis]
                step *= step
                apart += step
            inside = np.flatnonzero(apart.ravel() <= maybe)
            if len(inside):
                of_l, of_r = np.divmod(inside, len(around))
                yield (_pick_best if best else _pick)(left, right, order, rows_l[start + at + of_l], rows_r[around[of_r]], apart.ravel()[inside], by)


def _cell_codes(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    code = np.zeros(len(left) + len(right), np.int64)
    for name in ("cy", "cx", "_left_part"):
        if name in left.column_names:
            both = np.concatenate([left.column(name).to_numpy(), right.column(name).to_numpy()])
            at = np.unique(both, return_inverse=True)[1]
            code = np.unique(code * (at.max() + 1) + at, return_inverse=True)[1]
    return code[: len(left)], code[len(left) :]


def _task(left: pa.Table, right: pa.Table, by: _Scoring, schema: pa.Schema, best: bool, carried: tuple[Sequence[str], Sequence[str]]) -> pa.Table:
    if not len(left) or not len(right):
        return schema.empty_table()
    of_l, of_r = _Side(left, by.codes(left.column("_kind"), by.kinds)), _Side(right, by.codes(right.column("_category"), by.categories))
    sort = pc.sort_indices(right.select(["_right"]), sort_keys=[("_right", "ascending")], null_placement="at_start").to_numpy()
    order = np.empty(len(sort), np.int64)
    order[sort] = np.arange(len(sort))
    cell_l, cell_r = _cell_codes(left, right)
    by_l, by_r = np.argsort(cell_l, kind="stable"), np.argsort(cell_r, kind="stable")
    cells = np.intersect1d(cell_l, cell_r)
    bounds_l, bounds_r = (
        [np.searchsorted(codes[rows], cells, side) for side in ("left", "right")] for codes, rows in ((cell_l, by_l), (cell_r, by_r))
    )
    found = [
        picks
        for a, b, c, d in zip(*bounds_l, *bounds_r)
        for picks in _cell(of_l, of_r, order, by_l[a:b], by_r[c:d], by, best)
    ]
    if not found:
        return schema.empty_table()
    rows_l, rows_r, n, rank, sure = (np.concatenate(parts) for parts in zip(*found))
    similarity = by.similarity[of_l.codes[rows_l], of_r.codes[rows_r]]
    columns = [
        left.column("_left").take(pa.array(rows_l)).combine_chunks(),
        right.column("_right").take(pa.array(rows_r)).combine_chunks(),
        pa.array(n / 100.0), pa.array(similarity), pa.array(rank.astype(np.int32)), pa.array(sure),
        *(table.column(name).take(pa.array(rows)).combine_chunks() for table, rows, names in ((left, rows_l, carried[0]), (right, rows_r, carried[1])) for name in names),
    ]
    return pa.Table.from_arrays(columns, schema.names)


def plain_scores(affinity: DataFrame) -> Scores | None:
    """The affinity table as a mapping; None where it is too large for one, has pairs twice or scores that are no numbers."""
    listed = affinity.where("service_name is not null and category is not null").select(
        "service_name", "category", F.coalesce(F.col("score").cast("double"), F.lit(0.0))
    ).limit(MAX_SCORES + 1).toLocalIterator()
    scores, kinds, categories = {}, set(), set()
    for kind, category, score in listed:
        kinds.add(kind)
        categories.add(category)
        if (kind, category) in scores or not math.isfinite(score) or (len(kinds) + 1) * (len(categories) + 1) > MAX_SCORES:
            return None
        scores[kind, category] = score
    return scores


def nearest_ranked(
    left: DataFrame,
    right: DataFrame,
    scores: Scores,
    left_id: str,
    right_id: str,
    kind: str,
    category: str,
    radius_m: float = RADIUS_M,
    geo_weight: float = GEO_WEIGHT,
    cat_weight: float = CAT_WEIGHT,
    left_at: tuple[str, str] = ("lat", "lon"),
    right_at: tuple[str, str] = ("latitude", "longitude"),
    right_rows: int = RIGHT_ROWS,
    best: bool = False,
    carried: tuple[Sequence[str], Sequence[str]] = ((), ()),
) -> DataFrame | None:
    """For every left row with a right row within the radius: both ids, distance_m, category_similarity and match_rank of
    its closest match, or with ``best`` of its best, and ``decided``; if that is false, only the left id counts. ``carried``
    names columns of each side that are added.

    Left rows are ranked each on its own, so their ids should be unique. ``kind`` and ``category`` name the columns that
    ``scores`` are looked up by. None if a cell has more than ``right_rows`` right rows or the radius is above
    ``MAX_RADIUS_M``. Counting the rows by cell runs when called.
    """
    if not 0 < radius_m <= MAX_RADIUS_M:
        return None
    cell_m = CELL_RADII * radius_m
    stay = _located(left, left_at, F.col(left_id).alias("_left"), F.col(kind).alias("_kind"), *carried[0])
    move = _located(right, right_at, F.col(right_id).alias("_right"), F.col(category).alias("_category"), *carried[1])
    stay = stay.withColumn("_cell", own_cell("_lat", "_lon", cell_m)).select("*", "_cell.cy", "_cell.cx").drop("_cell")
    move = move.withColumn("_cell", F.explode(cells_touched("_lat", "_lon", radius_m, cell_m))).select("*", "_cell.cy", "_cell.cx").drop("_cell")
    dealt = left_in_parts(stay, move, ["cy", "cx"], LEFT_ROWS, CANDIDATES, right_rows, ["_left", "_lat", "_lon"])
    if dealt is None:
        return None
    stay, move, keys, rows, candidates = dealt
    least = left.sparkSession.sparkContext.defaultParallelism
    tasks = max(least, math.ceil(rows / ROWS_PER_TASK), math.ceil(candidates / CANDIDATES_PER_TASK))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(tasks * BUCKETS_PER_TASK)).alias("_task")
    stay, move = (side.select("*", bucket).repartition(tasks, "_task") for side in (stay, move))
    out = T.StructType(
        [
            T.StructField(left_id, left.schema[left_id].dataType),
            T.StructField(right_id, right.schema[right_id].dataType),
            T.StructField("distance_m", T.DoubleType()),
            T.StructField("category_similarity", T.DoubleType()),
            T.StructField("match_rank", T.IntegerType()),
            T.StructField("decided", T.BooleanType()),
            *[T.StructField(name, side.schema[name].dataType) for side, names in ((left, carried[0]), (right, carried[1])) for name in names],
        ]
    )
    arrow, scoring = to_arrow_schema(out), (dict(scores), float(radius_m), float(geo_weight), float(cat_weight))

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        return _task(one, other, _Scoring(*scoring), arrow, best, carried)

    ship_sources(left.sparkSession)
    return stay.groupBy("_task").cogroup(move.groupBy("_task")).applyInArrow(run, out)
