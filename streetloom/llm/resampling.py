"""Target-distribution importance resampling with bit-sliced aggregation.

Runs of words are hashed into buckets. A bucket's gain says how much likelier the target texts use it than the
corpus, as a whole number. A document's weight is the floored mean of the gains over its features; documents
are drawn without replacement by the largest sums of weight and Gumbel noise that follows from their id.

The sums are exact and bit-sliced: bit j of a document's bucket counts forms a plane of one bit for each bucket,
and so does bit i of the positive and of the negative gains. The gains' sum over the document is the sum over
all (i, j) of +-2^(i+j) times the number of bits that both planes share.

Each text is split and hashed once: a written table keeps bucket counts, from which the totals (one row for
each bucket and task, summed after a small exchange) and then the weights are made. Ranks come from ranges of the
drawn rows and the ranges' sizes, so no task sorts them all; where the draw ends is read off the number of rows
at each score. Scores are whole thousandths between fixed ends, so there are at most some hundred thousand of
them, however many documents there are.

Defined results: null and empty texts, and those without words, have no features and weight 0; rows that repeat are
weighed and drawn separately; a null id counts as the empty text in the noise and comes last among ties;
without target texts all gains follow from the corpus alone; a draw of less than one row draws none. Only id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetloom.llm.common import hand_back, map_batches, ship, texts_of
from streetloom.llm.decontaminate import words_of
from streetloom.session import checkpointed, scratch_path

BUCKETS = 10_000
WIDTH = 1  # longest run of words that is a feature
SHARE = 10  # per cent of the eligible documents that are drawn
LEAST_WORDS = 20
SEED = 2024
ROWS = 256  # documents whose planes are laid out together

_COUNTED = "n_words bigint, n_features bigint, buckets binary, counts binary"


def _features(words: list[bytes], width: int) -> Iterator[bytes]:
    yield from words
    for size in range(2, width + 1):
        for at in range(len(words) - size + 1):
            yield b" ".join(words[at : at + size])


def bucket_counts(docs: DataFrame, text: str = "text", width: int = WIDTH, buckets: int = BUCKETS) -> DataFrame:
    """``_id`` if there is one, n_words, n_features, and the occupied buckets with their counts."""
    carried = [c for c in docs.columns if c == "_id"]
    schema = ", ".join([f"_id {docs.schema[c].dataType.simpleString()}" for c in carried] + [_COUNTED])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_features, occupied, counts = [], [], [], []
        for content in texts_of(batch.column(text)):
            words = words_of(content)
            found = (np.fromiter(map(zlib.crc32, _features(words, width)), np.int64) % buckets).astype(np.int32)
            each, times = np.unique(found, return_counts=True)
            n_words.append(len(words))
            n_features.append(len(found))
            occupied.append(each.tobytes())
            counts.append(times.astype(np.int32).tobytes())
        columns = [batch.column(c) for c in carried]
        columns += [pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(occupied, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [*carried, "n_words", "n_features", "buckets", "counts"])

    return map_batches(docs, work, schema)


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of every occupied bucket."""
    occupied = batch.column("buckets").to_pylist()
    rows = np.repeat(np.arange(batch.num_rows), [len(b) // 4 for b in occupied])
    buckets = np.frombuffer(b"".join(occupied), np.int32)
    counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int32)
    return rows, buckets, counts.astype(np.int64)


def bucket_totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            _, occupied, counts = _entries(batch)
            np.add.at(total, occupied, counts)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    parts = counted.select("buckets", "counts").mapInArrow(run, "bucket bigint, n bigint")
    made = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row for each bucket
        made[row["bucket"]] = row["n"]
    return made


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, in doubles."""
    size, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_corpus + size) / ((s + 1) * (all_target + size))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


class GainPlanes:
    """Signed gains as one plane of bits for each power of two and sign."""

    def __init__(self, gains: np.ndarray):
        self.buckets = len(gains)
        self.planes: list[tuple[int, int, np.ndarray]] = []
        for sign in (1, -1):
            size = np.maximum(gains * sign, 0)
            for power in range(int(size.max(initial=0)).bit_length()):
                self.planes.append((sign, power, _packed(((size >> power) & 1).astype(bool)[None, :])[0]))

    def sums(self, rows: np.ndarray, buckets: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
        """For each of ``size`` documents the sum of gains over its features; rows rise."""
        total = np.zeros(size, np.int64)
        for start in range(0, size, ROWS):
            a, b = np.searchsorted(rows, (start, start + ROWS))
            row, bucket, count = rows[a:b] - start, buckets[a:b], counts[a:b]
            for j in range(int(count.max(initial=0)).bit_length()):
                some = (count >> j) & 1 == 1
                there, at = np.unique(row[some], return_inverse=True)
                bits = np.zeros((len(there), self.buckets), bool)
                bits[at, bucket[some]] = True
                plane = _packed(bits)
                for sign, i, gain in self.planes:
                    shared = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
                    total[start + there] += sign * (shared << (i + j))
        return total


def weigh(counted: DataFrame, gains: np.ndarray) -> DataFrame:
    """``_id``, n_words, n_features and weight of each row of ``bucket_counts``."""
    shared = counted.sparkSession.sparkContext.broadcast(GainPlanes(gains))  # some 30 planes of a bit for each bucket
    schema = f"_id {counted.schema['_id'].dataType.simpleString()}, n_words bigint, n_features bigint, weight bigint"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total = shared.value.sums(*_entries(batch), batch.num_rows)
        weight = total // np.maximum(batch.column("n_features").to_numpy(), 1)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight)], ["_id", "n_words", "n_features", "weight"])

    return map_batches(counted, work, schema)


def noise(id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(weighed: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Add score, and rank for the ``share`` per cent best of the documents with ``least_words`` words.

    ``weighed`` must be a stored table, as it is read three times. Runs when called.
    """
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("_id"), seed))
    eligible = F.col("n_words") >= least_words
    levels = scored.where(eligible).groupBy("score").count().collect()  # some hundred thousand scores at most
    wanted = sum(r["count"] for r in levels) * share // 100
    last, before = None, 0  # lowest score drawn
    for row in sorted(levels, key=lambda r: -r["score"]):
        if before >= wanted:
            break
        last, before = row["score"], before + row["count"]
    if last is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    leading = eligible & (F.col("score") >= last)
    order = [F.desc("score"), F.asc_nulls_last("_id"), F.asc("_tie")]
    ranged = checkpointed(
        scored.where(leading)
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id())
    )
    sizes = ranged.groupBy("_range").count()
    earlier = F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_range", F.coalesce(earlier, F.lit(0)).alias("_before"))  # one row for each range
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    place = F.col("_within") + F.col("_before")
    ranked = (
        ranged.withColumn("_within", within)
        .join(F.broadcast(offsets), "_range")
        .withColumn("rank", F.when(place <= wanted, place).cast("long"))
        .drop("_tie", "_range", "_within", "_before")
    )
    return ranked.unionByName(scored.where(~leading).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    width: int = WIDTH,
    buckets: int = BUCKETS,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """id (under its name), n_words, n_features, weight, score and rank (null: not drawn) of every document."""
    spark = docs.sparkSession
    ship(spark)
    counts_path, weights_path = scratch_path(spark, "buckets"), scratch_path(spark, "weights")
    named = docs.select(F.col(id).alias("_id"), F.col(text).alias("text"))
    bucket_counts(named, "text", width, buckets).write.parquet(counts_path)
    counted = spark.read.parquet(counts_path)
    wanted = bucket_counts(target.select(F.col(target_text).alias("text")), "text", width, buckets)
    gains = bucket_gains(bucket_totals(counted, buckets), bucket_totals(wanted, buckets))
    weigh(counted, gains).write.parquet(weights_path)
    drawn = draw(spark.read.parquet(weights_path), share, least_words, seed)
    return drawn.select(F.col("_id").alias(id), "n_words", "n_features", "weight", "score", "rank")
