"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts labelled good; unlabelled ones are a draw of all texts, whatever their labels. The risk
is the non-negative unbiased one: with class prior ``p``, loss ``l`` and score ``g``,
``p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])``; where the bracket turns negative, a step undoes the overfit
instead. No label of a bad text is used.

The prior is estimated from both draws: for every region of low scores that positives hardly enter, the share of
unlabelled texts outside, over the share of positives outside, bounds the prior from above; the smallest such
bound, with a standard error added for the draw's size, is taken. The texts are ordered by
models fitted on one half of the draws and read on the other, first with prior one half, then with the estimate.

Both draws are bounded: at most ``MAX_DRAW`` rows each, by a hash of id and text. They become a few counts for
each text on the executors, and only these reach the driver, where the small additive model is fitted: each measure
is cut at its quantiles, each piece has a weight. Every whole text is then scored.

Defined results: a null or empty text has the measures of no words and a score; rows with a null id are scored,
and drawn like others; labels that disagree count as not good; with no positives or no texts to learn from, all
scores are 0.5. Only key and text columns are used, so other columns cannot clash.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streetloom.llm.common import column_schema, map_batches, texts_of

MAX_DRAW = 30_000
PIECES = 24
STEPS = 400
ROUNDS = 3  # of estimating the prior
_SPAN = 1 << 30

MEASURES = (
    "words", "letters_per_word", "symbols", "bars", "same_as_last", "distinct", "capitals", "digits", "stops",
    "commas", "words_per_line", "repeated_lines", "beyond_ascii", "longest_run",
)


def measure(text: bytes | None) -> list[float]:
    """The measures of one text; shares are per word or per byte."""
    text = text or b""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split(b"\n") if line.strip()]
    same = list(map(operator.eq, words, words[1:]))
    run = longest = 0
    if any(same):
        for equal in same:
            run = run + 1 if equal else 0
            longest = max(longest, run)

    def share(characters: bytes) -> int:
        return len(text) - len(text.translate(None, characters))

    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        share(b"#*$%&<>^~=_{}[]\\@") / n,
        share(b"|") / n,
        sum(same) / n,
        len(set(words)) / n ** 0.9,
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size,
        share(b"0123456789") / size,
        share(b".!?") / n,
        share(b",;:") / n,
        float(np.log1p(n / max(1, len(lines)))),
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        share(bytes(range(128, 256))) / size,
        float(np.log1p(longest)),
    ]


@dataclass(frozen=True)
class QualityModel:
    """Cuts and weights of the additive model, and the estimated class prior."""

    cuts: np.ndarray  # measures x (pieces - 1)
    weights: np.ndarray  # measures x pieces
    bias: float
    prior: float

    def pieces(self, values: np.ndarray) -> np.ndarray:
        at = np.stack([np.searchsorted(c, values[:, k], "right") for k, c in enumerate(self.cuts)], axis=1)
        return at + np.arange(values.shape[1]) * self.weights.shape[1]

    def score(self, values: np.ndarray) -> np.ndarray:
        if not len(self.cuts):
            return np.full(len(values), 0.5)
        return 1 / (1 + np.exp(-(self.weights.ravel()[self.pieces(values)].sum(axis=1) + self.bias)))


def _fit_weights(good: np.ndarray, web: np.ndarray, model: QualityModel, prior: float, steps: int) -> QualityModel:
    """Adam on the non-negative risk with the sigmoid loss, which is bounded."""
    size = model.weights.size
    theta = np.zeros(size + 1)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    a, b = model.pieces(good), model.pieces(web)

    def gradient(at: np.ndarray, slope: np.ndarray) -> np.ndarray:
        grown = np.repeat(slope, at.shape[1])
        return np.append(np.bincount(at.ravel(), grown, size), slope.sum())

    for step in range(1, steps + 1):
        za = theta[a].sum(axis=1) + theta[size]
        zb = theta[b].sum(axis=1) + theta[size]
        pa_, pb = 1 / (1 + np.exp(-za)), 1 / (1 + np.exp(-zb))
        # of the loss 1 / (1 + exp(z)) for positives, 1 / (1 + exp(-z)) for negatives
        negative = pb.mean() - prior * pa_.mean()
        for_negative = gradient(b, pb * (1 - pb) / len(zb)) - gradient(a, prior * pa_ * (1 - pa_) / len(za))
        if negative >= 0:
            slope = gradient(a, -prior * pa_ * (1 - pa_) / len(za)) + for_negative
        else:
            slope = -for_negative
        slope[:size] += 1e-4 * theta[:size]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return QualityModel(model.cuts, theta[:size].reshape(model.weights.shape), float(theta[size]), prior)


def estimate_prior(good: np.ndarray, web: np.ndarray) -> float:
    """Smallest upper bound of the share of positives among unlabelled scores."""
    levels = np.unique(np.quantile(np.concatenate([good, web]), np.linspace(0, 0.95, 200)))
    of_good = 1 - np.searchsorted(np.sort(good), levels, "left") / len(good)
    of_web = 1 - np.searchsorted(np.sort(web), levels, "left") / len(web)
    usable = of_good > 0.5
    of_good, of_web = of_good[usable], of_web[usable]
    bounds = (of_web + np.sqrt(of_web * (1 - of_web) / len(web))) / of_good
    return float(np.clip(bounds.min(initial=0.99), 0.05, 0.99))


def fit(good: np.ndarray, web: np.ndarray) -> QualityModel:
    """Model from the measures of trusted positives and of unlabelled texts."""
    if len(good) < 2 or len(web) < 2:
        return QualityModel(np.empty((0, 0)), np.empty((0, 0)), 0.0, 0.5)
    inner = np.linspace(0, 1, PIECES + 1)[1:-1]
    # quantiles of both draws, so that values which only bad texts take get pieces as well
    both = np.concatenate([np.quantile(good, inner[::2], axis=0), np.quantile(web, inner[1::2], axis=0), np.quantile(good, [0.995, 1.0], axis=0)])
    cuts = np.sort(both, axis=0).T
    start = QualityModel(cuts, np.zeros((len(cuts), cuts.shape[1] + 1)), 0.0, 0.5)
    # texts are ordered by models that have not seen them, or known positives would look better than unknown ones;
    # a model fitted with a better prior orders the doubtful texts better
    prior = 0.5
    for _ in range(ROUNDS):
        bounds = []
        for part in (0, 1):
            ordering = _fit_weights(good[part::2], web[part::2], start, prior, STEPS)
            bounds.append(estimate_prior(ordering.score(good[1 - part :: 2]), ordering.score(web[1 - part :: 2])))
        prior = sum(bounds) / 2
    return _fit_weights(good, web, start, prior, STEPS)


def _measured(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [measure(t) for t in texts_of(batch.column("_text"))]
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(values, pa.list_(pa.float64()))], [*keys, "values"])

    return map_batches(docs.select(*keys, "_text"), work, f"{column_schema(docs.select(*keys))}, values array<double>")


def draw(key: Column, rows: int) -> Column:
    """Whether a hash puts a row among about ``MAX_DRAW`` of ``rows``."""
    return F.pmod(key, F.lit(_SPAN)) < F.lit(float(_SPAN)) * MAX_DRAW / F.greatest(F.lit(rows), F.lit(1))


def _drawn(texts: DataFrame) -> np.ndarray:
    """Measures of the ``MAX_DRAW`` rows with the smallest ``_key``; each task hands on no more than that."""
    rows = _measured(texts.select("_key", "_text"), ["_key"]).orderBy("_key").limit(MAX_DRAW).select("values").toPandas()
    return np.array(rows["values"].tolist(), float).reshape(-1, len(MEASURES))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> QualityModel:
    """Fit on the rows of which ``may_learn``, an expression of the id, is true.

    Rows are drawn by a hash of id and text, so rows without an id are drawn like others; rows with equal id and text
    are drawn together, but never more than ``MAX_DRAW`` rows of a kind.
    """
    good = labels.groupBy(F.col(doc_id).alias(doc_id)).agg(F.min(F.coalesce(quality, F.lit(0))).alias("_good"))
    good = good.where("_good = 1").where(may_learn).select(F.col(doc_id).alias("_id"))
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), may_learn.alias("_may")).where("_may")
    texts = texts.withColumn("_key", F.xxhash64("_id", "_text"))
    n_good, n_web = good.count(), texts.count()
    few = good.where(draw(F.xxhash64("_id"), n_good))  # about MAX_DRAW ids
    return fit(_drawn(texts.join(F.broadcast(few), "_id", "left_semi")), _drawn(texts.where(draw(F.col("_key"), n_web))))


def score(docs: DataFrame, model: QualityModel, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys`` and score, from 0 to 1, higher for better texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([measure(t) for t in texts_of(batch.column("_text"))], float).reshape(-1, len(MEASURES))
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(shared.value.score(values))], [*keys, "score"])

    read = docs.select(*keys, F.col(text).alias("_text"))
    return map_batches(read, work, f"{column_schema(docs.select(*keys))}, score double")
