"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.session import ship_sources

SPACE = "\x20\x09-\x0d"  # white space of every contract, inside a character class
SLICE_BYTES = 2 << 20
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2_000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def ship(spark: SparkSession) -> None:
    """Hand this package's sources to the executors, and bound the Arrow batches that they exchange with Python by rows
    and bytes, where the session allows more."""
    for name, most in ARROW_LIMITS.items():
        if int(spark.conf.get(name).rstrip("b")) > most:
            spark.conf.set(name, str(most))
    ship_sources(spark)


class WordHashes(dict):
    """64-bit hashes of words; a Python worker remembers some of them."""

    LIMIT = 60_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


WORD_HASHES = WordHashes()


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 of every text."""
    return column.cast(pa.binary()).to_pylist()


def sliced(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes, so that Python objects stay few."""
    rows = max(1, int(batch.num_rows * min(1.0, most / max(1, batch.nbytes))))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def hand_back() -> None:
    """Return freed memory to the system at a task's end, as a Python worker that waits for work keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``work`` on every Arrow batch, cut to about ``SLICE_BYTES``; None for an answer adds no rows."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                made = work(part)
                if made is not None:
                    yield made
        hand_back()

    return df.mapInArrow(run, schema)


def column_schema(df: DataFrame) -> str:
    """DDL of all columns, names quoted."""
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)


def replace_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return batch.set_column(batch.schema.get_field_index(name), name, values)


def crc_class(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    return crc_class(doc_id, modulus) == remainder


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the array's order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
