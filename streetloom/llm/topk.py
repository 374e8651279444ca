"""Exact top-k inner products over an impact-ordered index that is read score-at-a-time.

Every component x becomes the whole number floor(scale * x). The index holds blocks of vectors; in a block each
dimension has one posting list, ordered by falling impact (the size of the component), so that equal impacts
form segments. A query meets the segments of all dimensions by falling product of its own component and the
impact, adds them up, and bounds what the unread rest can still add to each vector: a vector that has been met
in all but m dimensions gains at most the m largest frontiers. It stops only when this proves that few vectors
can still be among the k best; these possible members are scored exactly.

Blocks hold about ``BLOCK_ELEMENTS`` numbers, whatever the length of the vectors. Queries are broadcast in
blocks of at most ``QUERY_BYTES``, one pass over the index for each, so neither side has to fit anywhere. A task
keeps the k best of each query over its index blocks, and what tasks found is ranked after one small exchange.

Defined results: a vector that is null or holds a null, a NaN or an infinity takes no part; an empty one does
and scores 0; of vectors of different lengths the missing components count as 0; quantised components beyond
+-2^26 count as +-2^26; each row is a vector of its own, so rows with one id answer and are found separately, and
a row only leaves itself out; a null id is found but asks nothing, and comes last among ties. Only id and vector
are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetloom.llm.common import hand_back, ship, sliced
from streetloom.session import scratch_path

SCALE = 256
BLOCK_ELEMENTS = 1 << 20
QUERY_BYTES = 64 << 20
MOST = 1 << 26  # of a quantised component; 2,000 products of two such add up below 2^63
START, STEP = 0.1, 0.6  # down to which share of the highest impact the first round reads, and each next one
FEW = 256  # possible members (or a sixth of a block) are scored exactly rather than bounded further

_INDEX = "block bigint, width int, ids array<bigint>, vectors binary, postings binary"
_STORED = "query_id bigint, block bigint, position int, vector binary"
_FOUND = "query_block bigint, query_position int, query_id bigint, block bigint, position int, vec_id bigint, score bigint"


def _quantised(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole-number vectors of the rows that take part, apart by length class so that padding stays small."""
    column = batch.column("vector")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.nan_to_num(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(np.maximum(lengths, 0))))
    odd = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    part = (lengths >= 0) & (odd[starts[1:]] == odd[starts[:-1]])
    classes = np.frexp(np.maximum(lengths, 0).astype(np.float64))[1]
    for kind in np.unique(classes[part]).tolist():
        rows = np.flatnonzero(part & (classes == kind))
        size = lengths[rows]
        made = np.zeros((len(rows), int(size.max())), np.int32)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        found = flat[np.repeat(starts[rows], size) + at]
        with np.errstate(over="ignore"):
            made[np.repeat(np.arange(len(rows)), size), at] = np.clip(np.floor(found * scale), -MOST, MOST)
        yield batch.column("id").take(pa.array(rows)), made


def _index_row(number: int, ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
    width = max(p.shape[1] for p in parts)
    vectors = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])
    postings = np.argsort(-np.abs(vectors.T), axis=1, kind="stable").astype(np.int32)
    named = pa.concat_arrays(ids)
    columns = [
        pa.array([number], pa.int64()),
        pa.array([width], pa.int32()),
        pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named),
        pa.array([vectors.tobytes()], pa.binary()),
        pa.array([postings.tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "width", "ids", "vectors", "postings"])


def write_index(
    vectors: DataFrame, path: str, id: str = "vec_id", vector: str = "embedding", scale: float = SCALE
) -> DataFrame:
    """Write the index as Parquet to the fresh folder ``path`` and read it back: one row for each block."""
    spark = vectors.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # a repeated task numbers its blocks alike
        pending: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for part in sliced(batch):
                for ids, made in _quantised(part, scale):
                    kind = made.shape[1].bit_length()
                    names, parts = pending.setdefault(kind, ([], []))
                    names.append(ids)
                    parts.append(made)
                    if sum(p.size for p in parts) >= BLOCK_ELEMENTS:
                        yield _index_row(number, *pending.pop(kind))
                        number += 1
        for names, parts in pending.values():
            yield _index_row(number, names, parts)
            number += 1
        hand_back()

    picked = vectors.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    picked.mapInArrow(run, _INDEX).write.parquet(path)
    return spark.read.schema(_INDEX).parquet(path)


def stored_vectors(index: DataFrame, divisor: int) -> DataFrame:
    """Queries out of the index: its rows whose id is divisible by ``divisor``, each with its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, nulls, vectors = _block(batch, at)
                rows = np.flatnonzero(~nulls & (ids % divisor == 0))
                columns = [
                    pa.array(ids[rows], pa.int64()),
                    pa.array(np.full(len(rows), batch.column("block")[at].as_py()), pa.int64()),
                    pa.array(rows, pa.int32()),
                    pa.array([v.tobytes() for v in vectors[rows]], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "block", "position", "vector"])

    return index.select("block", "width", "ids", "vectors").mapInArrow(run, _STORED)


def _block(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    named = batch.column("ids")[at].values
    nulls = named.is_null().to_numpy(zero_copy_only=False)
    ids = named.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    vectors = np.frombuffer(batch.column("vectors")[at].as_buffer(), np.int32)
    return ids, nulls, vectors.reshape(len(ids), batch.column("width")[at].as_py())


class _Postings:
    """One block: posting lists by falling impact, whose segments are found by binary search."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        self.number = batch.column("block")[at].as_py()
        self.ids, self.nulls, self.vectors = _block(batch, at)
        self.rows, self.width = self.vectors.shape
        order = np.frombuffer(batch.column("postings")[at].as_buffer(), np.int32)
        self.order = order.reshape(self.width, self.rows).astype(np.intp)
        self.values = np.take_along_axis(self.vectors.T, self.order, 1).astype(np.float64)
        self.impacts = np.abs(self.values)
        dims = np.arange(self.width, dtype=np.int64)[:, None] << 32
        self.keys = (dims + (MOST - self.impacts).astype(np.int64)).ravel()  # rises through all lists
        self.order, self.values = self.order.ravel(), self.values.ravel()

    def depths(self, dims: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Of each list in ``dims``, how many postings have an impact of ``least`` or more."""
        wanted = (dims << 32) + (MOST - np.minimum(least, MOST + 1)).astype(np.int64)
        return np.searchsorted(self.keys, wanted, "right") - dims * self.rows

    def possible(self, query: np.ndarray, own: int, best: _Best) -> np.ndarray:
        """Positions that may be among the k best; all others are proven not to be."""
        dims = np.flatnonzero(query[: self.width])
        sizes = np.abs(query[dims]).astype(np.float64)
        total, met = np.zeros(self.rows), np.zeros(self.rows, np.int64)
        if not len(dims):
            return np.flatnonzero(total >= best.least)
        base, signed = dims * self.rows, query[dims].astype(np.float64)
        at = np.zeros(len(dims), np.int64)
        tops = sizes * self.impacts[dims, 0]
        level = float(tops.max()) * START
        slack = 2.0**-50 * float(tops.sum())  # of sums in doubles, for huge components
        while True:
            to = np.maximum(at, self.depths(dims, np.maximum(np.ceil(level / sizes), 1)))
            spans = list(zip((base + at).tolist(), (base + to).tolist(), strict=True))
            rows = np.concatenate([self.order[a:b] for a, b in spans])
            gains = np.concatenate([self.values[a:b] for a, b in spans])
            total += np.bincount(rows, gains * np.repeat(signed, to - at), self.rows)
            met += np.bincount(rows, minlength=self.rows)
            at = to
            inside = np.minimum(at, self.rows - 1)
            frontier = np.where(at < self.rows, sizes * self.impacts[dims, inside], 0.0)
            rest = np.concatenate(([0.0], np.cumsum(np.sort(frontier)[::-1])))  # of the m largest frontiers
            if not best.full and best.least == -np.inf:
                self.seed(query, total, own, best)
            members = np.flatnonzero(total + rest[len(dims) - met] + slack >= best.least)
            if len(members) <= max(FEW, self.rows // 6) or rest[-1] == 0:
                return members
            level *= STEP if level >= 1 else 0

    def seed(self, query: np.ndarray, total: np.ndarray, own: int, best: _Best) -> None:
        """Exact scores of the vectors that lead now bound the k-th score from below."""
        leaders = min(best.k + 1, self.rows)
        leading = np.argpartition(total, self.rows - leaders)[self.rows - leaders :]
        scores = np.sort(self.exact(query, leading[leading != own]))
        if len(scores) >= best.k:
            best.least = max(best.least, float(scores[-best.k]))

    def exact(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.vectors[rows].astype(np.int64) @ query[: self.width]

    def search(self, query: np.ndarray, own: int, best: _Best) -> None:
        if len(query) < self.width:
            query = np.pad(query, (0, self.width - len(query)))
        rows = self.possible(query, own, best)
        rows = rows[rows != own]
        best.add(self.exact(query, rows), self.ids[rows], self.nulls[rows], np.full(len(rows), self.number), rows)


class _Best:
    """The k best of one query so far, by falling score, then rising id."""

    def __init__(self, k: int):
        self.k = k
        self.least = -np.inf  # no lower score can be among the k best
        self.columns = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)]

    @property
    def full(self) -> bool:
        return len(self.columns[0]) == self.k

    def add(self, scores: np.ndarray, *more: np.ndarray) -> None:
        keep = scores >= self.least
        joined = [np.concatenate((old, new[keep])) for old, new in zip(self.columns, (scores, *more), strict=True)]
        score, ids, nulls, blocks, rows = joined
        first = np.lexsort((rows, blocks, ids, nulls, -score))[: self.k]
        self.columns = [c[first] for c in joined]
        if self.full:
            self.least = max(self.least, float(self.columns[0][-1]))


def _query_blocks(queries: DataFrame) -> tuple[int, Iterator[list]]:
    """Number of blocks of about ``QUERY_BYTES`` at most, and the queries of each; only sizes are counted beforehand."""
    size = queries.agg(F.sum(F.octet_length("vector") + 64)).first()[0] or 0
    count = -(-size // QUERY_BYTES) * 2 if size > QUERY_BYTES else 1  # half-filled, as hashing is uneven
    part = F.pmod(F.xxhash64("block", "position"), F.lit(count))
    return count, (queries.where(part == number).collect() for number in range(count))


def _one_pass(index: DataFrame, rows: list, k: int) -> tuple[DataFrame, Broadcast]:
    """What the tasks find for some queries, and the broadcast of these."""
    places = [(r["block"], r["position"], r["query_id"]) for r in rows]
    vectors = [np.frombuffer(r["vector"], np.int32) for r in rows]
    shared = index.sparkSession.sparkContext.broadcast((places, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, vectors = shared.value
        best = [_Best(k) for _ in places]
        for batch in batches:
            for at in range(batch.num_rows):
                postings = _Postings(batch, at)
                for (block, position, _), vector, found in zip(places, vectors, best, strict=True):
                    postings.search(vector.astype(np.int64), position if block == postings.number else -1, found)
        sizes = [len(b.columns[0]) for b in best]
        asked = [np.repeat(np.array([p[c] for p in places], np.int64), sizes) for c in range(3)]
        score, ids, nulls, blocks, rows = (np.concatenate([b.columns[c] for b in best] or [np.zeros(0, np.int64)]) for c in range(5))
        columns = [
            pa.array(asked[0]),
            pa.array(asked[1].astype(np.int32)),
            pa.array(asked[2]),
            pa.array(blocks),
            pa.array(rows.astype(np.int32)),
            pa.array(ids, mask=nulls.astype(bool)),
            pa.array(score),
        ]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _FOUND.split(", ")])
        hand_back()

    return index.mapInArrow(run, _FOUND), shared


def search(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` best rows of ``index`` for each row of ``queries``.

    ``queries`` has the columns of ``stored_vectors``; a query leaves out the row at its own place (block and
    position, null for a vector from outside). It is read when called, in blocks.
    """
    count, blocks = _query_blocks(queries)
    if count == 1:
        found, _ = _one_pass(index, next(blocks), k)
    else:  # what a block of queries finds is written, so that one broadcast lives at a time
        spark, path = index.sparkSession, scratch_path(index.sparkSession, "found")
        for rows in blocks:
            part, shared = _one_pass(index, rows, k)
            part.write.mode("append").parquet(path)
            shared.destroy()
        found = spark.read.schema(_FOUND).parquet(path)
    asked = ["query_block", "query_position", "query_id"]
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), "block", "position"]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*asked).orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
