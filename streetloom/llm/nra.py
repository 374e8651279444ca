"""Ranked lexical search by NRA: sorted reads only, with a score interval for every document.

Documents are cut into shards of bounded size. In a shard each query term has a posting list in falling impact.
A query reads its lists from the top, all down to the same contribution in a round. What a document has been
given so far is the lower end of its interval; the frontiers of the lists that have not shown it yet make up the
rest. Reading goes on until no document outside the best k can reach the k-th lower end, ties included, and then
along the lists that members have not been seen in, until their intervals are single numbers. No document is
looked up at random.

Texts are split into words once: a written table keeps each document's number of terms and its counts of query
terms, from which the corpus statistics and then the shards are made. Queries come in blocks of at most
``BLOCK_BYTES`` of text, one such round for each, so that the broadcast terms are bounded.

Score: the sum over a query's terms, repeats included, of w * ((10^9 * tf) div (1000 * tf + 8 * m)), where
w = floor(1000 * ln((2N + 2) / (2df + 1))) and m = 25 + (75 * n * N) div L.

Defined results: null and empty texts, and those without words, have no terms, are never found and find nothing;
each row is a document or a query of its own, so rows with one id are ranked and answered separately; a null
document id comes last among ties; documents with score 0 are not found. Only id and text are read, so other
columns cannot clash. Ids of documents are whole numbers, those of queries may be of any type.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streetloom.llm.common import hand_back, map_batches, ship, texts_of
from streetloom.llm.decontaminate import words_of
from streetloom.session import checkpointed, scratch_path

BLOCK_BYTES = 16 << 20
SHARD_POSTINGS = 1 << 20
SHARD_DOCUMENTS = 1 << 16
TF, MIX, LENGTH, BASE = 10**9, 1000, 8, 25  # of the score, see above
SPREAD = 75

_TERMS = "doc_id bigint, n bigint, terms binary, counts binary"
_FOUND = "query int, doc_id bigint, score bigint"


class Queries:
    """The texts of one block as numbered terms with their repeats."""

    def __init__(self, texts: list[str]):
        self.numbers: dict[bytes, int] = {}
        self.terms: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        for text in texts:
            counted = Counter(words_of(text.encode()))
            self.terms.append(np.array([self.numbers.setdefault(w, len(self.numbers)) for w in counted], np.int64))
            self.repeats.append(np.array(list(counted.values()), np.int64))


def _term_rows(docs: DataFrame, shared) -> DataFrame:
    """Of each document: its number of terms, and number and count of each query term in it."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        numbers = shared.value
        sizes, terms, counts = [], [], []
        for content in texts_of(batch.column("text")):
            words = words_of(content)
            found = [n for n in map(numbers.get, words) if n is not None]
            each, times = np.unique(np.array(found, np.int32), return_counts=True)
            sizes.append(len(words))
            terms.append(each.tobytes())
            counts.append(times.astype(np.int32).tobytes())
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return map_batches(docs, work, _TERMS)


def _document_frequencies(rows: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term: counted in tasks, added up after one small exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    counted = rows.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    made = np.zeros(terms, np.int64)
    for row in counted.collect():  # at most one row for each term of the block
        made[row["term"]] = row["n"]
    return made


class Shard:
    """Some documents and their posting lists in falling impact."""

    def __init__(self, ids: pa.Array, sizes: np.ndarray, held: np.ndarray, terms: np.ndarray, counts: np.ndarray, corpus: tuple[int, int]):
        documents, words = corpus
        self.rows = len(ids)
        self.nulls = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(self.rows), held)
        length = BASE + SPREAD * sizes * documents // words
        impacts = TF * counts // (MIX * counts + LENGTH * length[owner])
        order = np.argsort((terms << 20) - impacts, kind="stable")  # an impact is below 10^6
        self.terms, self.owners, self.impacts = terms[order], owner[order], impacts[order]

    def lists(self, terms: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Owners and contributions of each term that occurs and counts."""
        starts, ends = np.searchsorted(self.terms, terms), np.searchsorted(self.terms, terms, "right")
        return [
            (self.owners[a:b], self.impacts[a:b] * w)
            for a, b, w in zip(starts.tolist(), ends.tolist(), weights.tolist(), strict=True)
            if b > a and w
        ]

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are among the ``k`` best and reach ``least``, ties at the end included, with final scores."""
        lists = self.lists(terms, weights)
        low = np.zeros(self.rows, np.int64)
        seen = np.zeros((len(lists), self.rows), bool)
        at = [0] * len(lists)
        frontier = np.array([c[0] for _, c in lists], np.int64)
        members = np.zeros(0, np.int64)
        level = int(frontier.max()) if lists else 0
        while lists:
            level //= 2
            for i, (owners, gains) in enumerate(lists):
                if frontier[i] >= max(level, 1):
                    to = int(np.searchsorted(-gains, -level, "right"))
                    low[owners[at[i] : to]] += gains[at[i] : to]  # a list names a document once
                    seen[i, owners[at[i] : to]] = True
                    at[i] = to
                    frontier[i] = gains[to] if to < len(gains) else 0
            rest = int(frontier.sum())
            bar = max(least, 1)
            if self.rows >= k:
                bar = max(bar, int(np.partition(low, self.rows - k)[self.rows - k]))
            members = np.flatnonzero(low + rest >= bar)
            members = members[low[members] + rest - frontier @ seen[:, members] >= bar]
            if len(members) <= k or not rest:
                break
        self._resolve(lists, at, frontier, members, low, seen)
        members = members[low[members] >= max(least, 1)]
        return members, low[members]

    def _resolve(self, lists, at, frontier, members, low, seen) -> None:
        """Read on where members are missing, to the end of a list if need be: their intervals close."""
        wanted = np.zeros(self.rows, bool)
        wanted[members] = True
        for i in np.flatnonzero(frontier).tolist():
            if not seen[i, members].all():
                owners, gains = lists[i][0][at[i] :], lists[i][1][at[i] :]
                hits = np.flatnonzero(wanted[owners])
                low[owners[hits]] += gains[hits]


def _shards(batches: Iterator[pa.RecordBatch], corpus: tuple[int, int]) -> Iterator[Shard]:
    ids, sizes, held, terms, counts = [], [], [], [], []
    postings = rows = 0

    def shard() -> Shard:
        named = pa.concat_arrays(ids)
        return Shard(named, *(np.concatenate(part) for part in (sizes, held, terms, counts)), corpus)

    for batch in batches:
        found = [batch.column(c).to_pylist() for c in ("terms", "counts")]
        ids.append(batch.column("doc_id"))
        sizes.append(batch.column("n").to_numpy())
        held.append(np.array([len(f) // 4 for f in found[0]], np.int64))
        terms.append(np.frombuffer(b"".join(found[0]), np.int32).astype(np.int64))
        counts.append(np.frombuffer(b"".join(found[1]), np.int32).astype(np.int64))
        postings, rows = postings + len(terms[-1]), rows + batch.num_rows
        if postings >= SHARD_POSTINGS or rows >= SHARD_DOCUMENTS:
            yield shard()
            ids, sizes, held, terms, counts = [], [], [], [], []
            postings = rows = 0
    if rows:
        yield shard()


def _search_shards(
    rows: DataFrame, queries: Queries, weights: np.ndarray, corpus: tuple[int, int], k: int
) -> tuple[DataFrame, Broadcast]:
    """The ``k`` best documents of each query in each task, and the broadcast of the queries; a task's shards hand their
    k-th score on."""
    asked = [(t, weights[t] * r) for t, r in zip(queries.terms, queries.repeats, strict=True)]
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)] for _ in shared.value]
        for shard in _shards(batches, corpus):
            for query, (terms, gains) in enumerate(shared.value):
                old = best[query]
                members, scores = shard.best(terms, gains, k, int(old[0][-1]) if len(old[0]) == k else 1)
                if len(members):
                    new = (scores, shard.ids[members], shard.nulls[members])
                    score, ids, nulls = (np.concatenate(pair) for pair in zip(old, new, strict=True))
                    first = np.lexsort((ids, nulls, -score))[:k]
                    best[query] = [score[first], ids[first], nulls[first]]
        number = np.repeat(np.arange(len(best), dtype=np.int32), [len(b[0]) for b in best])
        score, ids, nulls = (np.concatenate([b[c] for b in best] or [np.zeros(0, np.int64)]) for c in range(3))
        columns = [pa.array(number), pa.array(ids, mask=nulls.astype(bool)), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])
        hand_back()

    return rows.mapInArrow(run, _FOUND), shared


def _query_blocks(queries: DataFrame, id: str, text: str) -> tuple[int, Iterator[list]]:
    """Number of blocks of at most about ``BLOCK_BYTES`` of text, and the rows (id, text) of each; only sizes are counted
    beforehand."""
    rows = queries.select(F.col(id).alias("id"), F.col(text).alias("words")).where("words is not null")
    total = rows.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    if total <= BLOCK_BYTES:
        return 1, iter([rows.collect()])
    count = -(-total // BLOCK_BYTES) * 2  # half-filled, as dealing is uneven
    rows = checkpointed(rows.withColumn("part", F.pmod(F.xxhash64("words", F.monotonically_increasing_id()), F.lit(count))))
    return count, (rows.where(F.col("part") == number).collect() for number in range(count))


def rank_documents(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id: str = "doc_id",
    text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """query id (named ``query_id``), rank, doc_id, score of the ``k`` best documents of each query.

    The term table of each block of queries is written when called; the search itself runs with the result.
    """
    spark = docs.sparkSession
    ship(spark)
    picked = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    named = queries.schema[query_id].dataType
    count, blocks = _query_blocks(queries, query_id, query_text)
    path = scratch_path(spark, "ranked")
    for block in blocks:
        asked = Queries([r["words"] for r in block])
        terms = scratch_path(spark, "terms")
        numbers = spark.sparkContext.broadcast(asked.numbers)
        _term_rows(picked, numbers).write.parquet(terms)
        numbers.destroy()
        rows = spark.read.schema(_TERMS).parquet(terms)
        documents, words = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        frequencies = _document_frequencies(rows, len(asked.numbers))
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in frequencies.tolist()], np.int64)
        found, shared = _search_shards(rows.where("n > 0"), asked, weights, (documents, max(words, 1)), k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, r["id"]) for n, r in enumerate(block)], f"query int, id {named.simpleString()}")
        joined = ranked.join(F.broadcast(names), "query")  # as many rows as the block has queries
        result = joined.select(F.col("id").alias(query_id), "rank", "doc_id", "score")
        if count == 1:
            return result
        result.write.mode("append").parquet(path)  # so that the queries of one block are broadcast at a time
        shared.destroy()
    return spark.read.schema(result.schema).parquet(path)
