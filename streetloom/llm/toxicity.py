"""Toxicity by multiple-instance learning: a text is a bag of sentences, and only bags are labelled.

A sentence's probability is logistic in the words it holds; a text's is the noisy-or of its sentences,
``1 - prod(1 - p_s)``. Weights are fitted on the likelihood of the texts' labels, so the model finds by itself
which sentences made a text toxic, and ``offending`` names them. A word counts by itself and by its beginnings,
which lets inflected or made-up forms share what was learned. Words are hashed to ``SPACE`` places; only places
that toxic texts hold significantly more often than others get a weight, as in an open vocabulary nearly every
text has words that no other text has, which would explain its label and teach nothing.

Learning takes a bounded draw, at most ``MAX_DRAW`` labelled texts of either class, by the hash of the id; their hashed
words reach the driver, no text does. Every whole text is then scored.

Defined results: a null or empty text has one empty sentence and so a score; labels that disagree count as
toxic, null labels as not toxic; rows with a null id are scored; without texts of both classes all scores are 0.
Only key and text columns are used, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.llm.common import column_schema, map_batches, texts_of

MAX_DRAW = 4_000  # texts of each class
SPACE = 1 << 18
MIN_TEXTS = 4
PREFIXES = (4, 6)
EPOCHS = 40
_SPAN = 1 << 30
_WORD_CACHE = 100_000
_END = re.compile(rb"[.!?\n]+")
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


class _Places(dict):
    """Hashed places of a word and of its beginnings."""

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= _WORD_CACHE:
            self.clear()
        text = word.decode("utf-8", "replace")
        kinds = [b"w" + word] + [b"p" + text[:k].encode() for k in PREFIXES if len(text) > k]
        places = self[word] = [xxhash.xxh3_64_intdigest(k) % SPACE for k in kinds]
        return places


_PLACES = _Places()


def sentences(text: bytes | None) -> list[bytes]:
    """Pieces between full stops and line ends that hold a word; at least one, maybe empty, piece."""
    return [s for s in _END.split(text or b"") if s.strip()] or [b""]


def places_of(sentence: bytes) -> list[int]:
    """Distinct places of a sentence's words."""
    return list({p for w in sentence.lower().translate(_LETTERS).split() for p in _PLACES[w]})


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # one for each place
    bias: float

    def sentence_scores(self, parts: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((p for part in parts for p in part), np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        return _sigmoid(np.bincount(owner, self.weights[flat], len(parts)) + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def noisy_or(scores: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-12)).sum()))


def _telling(a: np.ndarray, b: np.ndarray, toxic: int, other: int) -> np.ndarray:
    """Places whose texts (``a`` toxic, ``b`` other) are toxic so much more often than chance allows among all places
    held by ``MIN_TEXTS`` texts: the likelihood ratio statistic exceeds twice the logarithm of their number."""
    n, share = a + b, toxic / (toxic + other)
    held = n >= MIN_TEXTS
    with np.errstate(divide="ignore", invalid="ignore"):
        statistic = 2 * (
            np.where(a > 0, a * np.log(a / (n * share)), 0) + np.where(b > 0, b * np.log(b / (n * (1 - share))), 0)
        )
    return held & (a > n * share) & (statistic > 2 * np.log(max(2, held.sum())))


def fit(flat: np.ndarray, part_sizes: np.ndarray, text_parts: np.ndarray, toxic: np.ndarray, prevalence: float | None = None) -> ToxicityModel:
    """``flat`` holds the places of all sentences, ``part_sizes`` how many each has, ``text_parts`` the number of
    sentences of each text; ``prevalence`` is the share of toxic texts where the draw was made."""
    if not len(toxic) or toxic.all() or not toxic.any():
        return ToxicityModel(np.zeros(SPACE), -40.0)
    text_of_part = np.repeat(np.arange(len(text_parts), dtype=np.int32), text_parts)
    # texts that hold a place, by class
    in_texts, in_toxic = np.zeros(SPACE, np.int64), np.zeros(SPACE, np.int64)
    ends = np.cumsum(part_sizes, dtype=np.int64)[np.cumsum(text_parts) - 1]
    for start, end, is_toxic in zip([0, *ends[:-1].tolist()], ends.tolist(), toxic.tolist(), strict=True):
        held = np.unique(flat[start:end])
        in_texts[held] += 1
        if is_toxic:
            in_toxic[held] += 1
    known = _telling(in_toxic, in_texts - in_toxic, int(toxic.sum()), int((~toxic).sum()))
    use = known[flat]
    part_of = np.repeat(np.arange(len(part_sizes), dtype=np.int32), part_sizes)[use]
    flat = flat[use]
    numbers = np.cumsum(known) - 1
    flat, size = numbers[flat].astype(np.int32), int(known.sum())
    theta = np.zeros(size + 1)
    theta[size] = -4.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    share = toxic.mean()
    prevalence = share if prevalence is None else prevalence
    for step in range(1, EPOCHS * 4 + 1):
        z = np.bincount(part_of, theta[flat], len(part_sizes)) + theta[size]
        p = _sigmoid(z)
        clear = np.exp(np.bincount(text_of_part, np.log1p(-np.minimum(p, 1 - 1e-9)), len(text_parts)))
        pull = np.where(toxic, clear / np.maximum(1 - clear, 1e-9) * prevalence / share, -(1 - prevalence) / (1 - share))
        slope_part = -(p * pull[text_of_part]) / len(toxic)
        slope = np.append(np.bincount(flat, slope_part[part_of], size), slope_part.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        rate = 0.1
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
        theta[:size] = np.sign(theta[:size]) * np.maximum(np.abs(theta[:size]) - rate * 0.004, 0)
    weights = np.zeros(SPACE)
    weights[known] = theta[:size]
    return ToxicityModel(weights, float(theta[size]))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> ToxicityModel:
    """Fit on labelled rows of which ``may_learn``, an expression of the id, is true."""
    known = labels.groupBy(F.col(doc_id).alias(doc_id)).agg(F.max(F.coalesce(toxic, F.lit(0))).alias("_toxic")).where(may_learn)
    sizes = {r["_toxic"]: r["n"] for r in known.where("_toxic in (0, 1)").groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    limit = F.when(F.col("_toxic") == 1, F.lit(float(_SPAN)) * MAX_DRAW / max(1, sizes.get(1, 0))).otherwise(
        F.lit(float(_SPAN)) * MAX_DRAW / max(1, sizes.get(0, 0))
    )
    drawn = known.where(F.pmod(F.xxhash64(doc_id), F.lit(_SPAN)) < limit).select(F.col(doc_id).alias("_id"), "_toxic")
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    marked = texts.join(F.broadcast(drawn), "_id").select("_toxic", "_text")  # at most about 2 * MAX_DRAW ids

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bags = []
        for content in texts_of(batch.column("_text")):
            parts = [places_of(s) for s in sentences(content)]
            sizes = np.array([len(p) for p in parts], np.int32)
            bags.append((sizes.tobytes(), np.array([p for part in parts for p in part], np.int32).tobytes()))
        columns = [pa.array([b[k] for b in bags], pa.binary()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([batch.column("_toxic"), *columns], ["toxic", "sizes", "places"])

    rows = map_batches(marked, work, "toxic int, sizes binary, places binary").toPandas()
    sizes_of = [np.frombuffer(s, np.int32) for s in rows["sizes"]]
    truth = rows["toxic"].to_numpy() == 1
    flat = np.frombuffer(b"".join(rows.pop("places")), np.int32)
    joined = np.concatenate(sizes_of) if sizes_of else np.empty(0, np.int32)
    return fit(flat, joined, np.array([len(s) for s in sizes_of], np.int64), truth, sizes.get(1, 0) / max(1, sum(sizes.values())))


def score(docs: DataFrame, model: ToxicityModel, keys: Sequence[str] = ("doc_id",), text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``keys``, score and offending: (start, end, score) of sentences at or above ``threshold``, as code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool, scores, offending = shared.value, [], []
        for content in texts_of(batch.column("_text")):
            found = sentences(content)
            each = tool.sentence_scores([places_of(s) for s in found])
            scores.append(noisy_or(each))
            offending.append(_located(content, found, each, threshold))
        made = [pa.array(scores, pa.float64()), pa.array(offending, span)]
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *made], [*keys, "score", "offending"])

    head = column_schema(docs.select(*keys))
    read = docs.select(*keys, F.col(text).alias("_text"))
    return map_batches(read, work, f"{head}, score double, offending array<struct<start:int,end:int,score:double>>")


def _located(content: bytes | None, found: list[bytes], each: np.ndarray, threshold: float) -> list[dict]:
    spans, at, points = [], 0, 0
    if (each < threshold).all() or not content:
        return spans
    for sentence, value in zip(found, each.tolist(), strict=True):
        start = content.index(sentence, at)
        points += len(content[at:start].decode())
        end = points + len(sentence.decode())
        if value >= threshold:
            spans.append({"start": points, "end": end, "score": value})
        at, points = start + len(sentence), end
    return spans
