"""Benchmark decontamination: documents that hold word windows of test items.

The windows of all items form a hash set that is broadcast; each task scans the word windows of its documents
against it. The set is built in blocks of bounded text size, one pass over the documents for each block, so a
broadcast never outgrows ``BLOCK_BYTES`` (or one item, if that is longer). A window is keyed by its word
numbers, so a hit is an equality of words, not of hashes.

Defined results: a null or empty text, or one without words, has no words and no hits; an item without words
has no window; an item shorter than the window is one window of its own length; items with equal windows all
count; rows that repeat are answered one by one; an item whose id is null marks words but is not listed. Only
the key columns are carried, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.llm.common import column_schema, map_batches, replace_column, texts_of
from streetloom.session import checkpointed

WINDOW = 10
BLOCK_BYTES = 32 << 20  # text of the items behind one broadcast

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(
    c if c >= 0x80 or c in _KEEP else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(_TABLE).split() if text else []


class Windows:
    """Normalised windows of some items, as a hash set of word numbers."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.found: dict[bytes, list[object]] = {}
        lengths = set()
        for item, text in items:
            words = words_of(text.encode() if text else None)
            if not words:
                continue
            numbers = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words], np.int32)
            length = min(window, len(words))
            lengths.add(length)
            for at in range(len(words) - length + 1):
                owners = self.found.setdefault(numbers[at : at + length].tobytes(), [])
                if not owners or owners[-1] != item:
                    owners.append(item)
        self.lengths = sorted(lengths)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set]:
        """Which words lie in a window (None: none does) and the items whose windows occur."""
        n = len(words)
        numbers = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, n)
        known = np.concatenate(([0], np.cumsum(numbers > 0)))
        marks, items = None, set()
        for length in self.lengths:
            if n < length:
                break
            for at in np.flatnonzero(known[length:] - known[:-length] == length).tolist():
                owners = self.found.get(numbers[at : at + length].tobytes())
                if owners is not None:
                    marks = np.zeros(n, bool) if marks is None else marks
                    marks[at : at + length] = True
                    items.update(owners)
        items.discard(None)
        return marks, items


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[object, str | None]]]:
    """Distinct items in blocks of at most ``BLOCK_BYTES`` of text.

    Only sizes are counted first; each block is then collected by itself while its windows are built.
    """
    items = benchmark.select(F.col(item).alias("item"), F.col(text).alias("words")).where("words is not null")
    total = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES) * 2 if total > BLOCK_BYTES else 1  # half-filled, as hashing is uneven
    part = F.pmod(F.xxhash64("item", "words"), F.lit(count))
    for number in range(count):
        rows = items.where(part == number).distinct().collect()
        yield sorted(((r["item"], r["words"]) for r in rows), key=repr)


def scan_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``keys``, n_words, hits (word ranges, end exclusive) and items (ids whose windows occur)."""
    state = docs.select(*keys, F.col(text).alias("_text"))
    return _scanned(state, benchmark, keys, item, item_text, window).select(*keys, "n_words", "hits", "items")


def _scanned(
    state: DataFrame, benchmark: DataFrame, keys: Sequence[str], item: str, item_text: str, window: int
) -> DataFrame:
    """``state`` (keys and _text) with n_words, hits and items."""
    item_type = benchmark.schema[item].dataType.simpleString()
    context = state.sparkSession.sparkContext
    for number, rows in enumerate(_blocks(benchmark, item, item_text)):
        if number:
            state = checkpointed(state)
        state = _one_pass(state, keys, context.broadcast(Windows(rows, window)), item_type)
    return state


def _one_pass(state: DataFrame, keys: Sequence[str], shared, item_type: str) -> DataFrame:
    head = column_schema(state.select(*keys))
    schema = f"{head}, _text string, n_words bigint, hits array<struct<start:int,end:int>>, items array<{item_type}>"
    first = "hits" not in state.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        windows: Windows = shared.value
        raw = texts_of(batch.column("_text"))
        earlier = [((), ())] * len(raw)
        if not first:
            earlier = list(zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True))
        counts, hits, items = [], [], []
        for content, (old_hits, old_items) in zip(raw, earlier, strict=True):
            words = words_of(content)
            marks, found = windows.scan(words)
            if old_hits:
                marks = np.zeros(len(words), bool) if marks is None else marks
                for span in old_hits:
                    marks[span["start"] : span["end"]] = True
            counts.append(len(words))
            hits.append([] if marks is None else _ranges(marks))
            items.append(sorted(found.union(old_items), key=repr))
        columns = [batch.column(k) for k in keys] + [batch.column("_text")]
        made = [
            pa.array(counts, pa.int64()),
            pa.array(hits, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            pa.array(items, pa.list_(_arrow_type(item_type))),
        ]
        return pa.RecordBatch.from_arrays(columns + made, [*keys, "_text", "n_words", "hits", "items"])

    return map_batches(state, work, schema)


def _arrow_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def _ranges(marks: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]


def remove_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    drop_share: float | None = 0.5,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` without benchmark words: hit ranges are cut from the texts, white space around them stays.

    Documents of whose words ``drop_share`` or more are hit go altogether (None: never). Texts without a hit
    are returned as they are. Repeated rows are treated alike; all columns are kept.
    """
    others = [c for c in docs.columns if c != text]
    row = F.struct(F.lit(0).alias("_"), *others)  # in one column no name can clash
    state = docs.select(row.alias("_row"), F.col(text).alias("_text"))
    found = _scanned(state, benchmark, ["_row"], item, item_text, window)
    if drop_share is not None:
        size = F.aggregate("hits", F.lit(0), lambda n, s: n + s["end"] - s["start"])
        found = found.where((size == 0) | (size < F.col("n_words") * drop_share))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        contents, hits = texts_of(batch.column("_text")), batch.column("hits").to_pylist()
        cut = [_cut(c, h) if h else c for c, h in zip(contents, hits, strict=True)]
        return replace_column(batch.select(["_row", "_text"]), "_text", pa.array(cut, pa.binary()).cast(pa.string()))

    found = found.select("_row", "_text", "hits")
    cut = map_batches(found, work, column_schema(found.select("_row", "_text")))
    return cut.select(*[F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])


def _cut(content: bytes, hits: list[dict]) -> bytes:
    spans = [m.span() for m in _WORD.finditer(content)]
    keep, at = [], 0
    for hit in hits:
        keep.append(content[at : spans[hit["start"]][0]])
        at = spans[hit["end"] - 1][1]
    return b"".join([*keep, content[at:]])
