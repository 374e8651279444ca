"""Resampling, vector search and ranked lexical search, against brute force."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from streetloom.llm import nra, resampling, topk
from streetloom.llm.decontaminate import words_of
from streetloom.session import scratch_path

# ---- resampling ------------------------------------------------------------------


def _features(text, width):
    words = words_of((text or "").encode())
    return len(words), [b" ".join(words[k : k + n]) for n in range(1, width + 1) for k in range(len(words) - n + 1)]


def _resampled(docs, target, width=1, buckets=10_000, share=10, least=20):
    bucket = lambda f: zlib.crc32(f) % buckets
    held = [_features(text, width) for _, text in docs]
    s, t = collections.Counter(bucket(f) for _, fs in held for f in fs), collections.Counter()
    for text in target:
        t.update(bucket(f) for f in _features(text, width)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for (doc_id, _), (n_words, fs) in zip(docs, held, strict=True):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, n_words, len(fs), weight, score))
    first = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = collections.defaultdict(list)
    for place, row in enumerate(first):
        ranks[row].append(place + 1 if place < len(first) * share // 100 else None)
    return sorted(((*row, ranks[row].pop(0) if row[1] >= least else None) for row in rows), key=repr)


def _texts(seed, count, vocabulary=300):
    rng = random.Random(seed)
    words = [f"Word{k}" for k in range(vocabulary)] + ["é", "Straße", "北京", "x1"]
    return [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 19, 20, 21, 80, 400]))) for _ in range(count)]


@pytest.mark.parametrize(("width", "buckets", "share"), [(1, 10_000, 10), (2, 97, 50), (1, 64, 100), (3, 1, 0)])
def test_resampling_equals_brute_force(spark, width, buckets, share):
    texts = _texts(1, 150)
    docs = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, texts[9]), (None, None), (7, "a " * 3_000)]
    target = _texts(2, 20, 40) + [None, ""]
    got = resampling.resample(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(t,) for t in target], "text string"),
        width=width,
        buckets=buckets,
        share=share,
    )
    want = _resampled(docs, target, width, buckets, share)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_bit_planes_equal_plain_sums():
    rng = np.random.default_rng(5)
    gains = rng.integers(-20_000, 20_000, 1_000)
    gains[::7] = 0
    counts = rng.integers(0, 3, (700, 1_000)) * rng.integers(0, 70_000, (700, 1_000))
    counts[5] = 0
    rows, buckets = np.nonzero(counts)
    got = resampling.GainPlanes(gains).sums(rows, buckets, counts[rows, buckets], 700)
    assert (got == counts @ gains).all()


def test_draw_of_equal_rows_is_whole(spark):
    """A third of all rows is one row over and over: ranks stay 1..n without gaps."""
    rows = [(1, "same words " * 15)] * 100 + [(k, f"w{k} " * 25) for k in range(200)]
    got = resampling.resample(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("same words",)], "text string"), share=60
    )
    kept = got.collect()
    assert len(kept) == 300 and sorted(r["rank"] for r in kept if r["rank"]) == list(range(1, 181))


def test_resampling_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    got = resampling.resample(odd_docs, odd_docs.limit(0))
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    rows = collections.Counter((r["doc_id"], r["n_words"]) for r in got.collect())
    assert sum(rows.values()) == odd_docs.count() and rows[(1, 12)] == 2 and rows[(2, 0)] == 1 and rows[(None, 0)] == 1
    assert resampling.resample(no_docs, odd_docs).count() == 0
    assert resampling.resample(odd_docs, no_docs).count() == odd_docs.count()


# ---- vector search ---------------------------------------------------------------


def _quantised(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * x) for x in vector]


def _nearest(rows, divisor, k):
    whole = [(at, vec_id, _quantised(v)) for at, (vec_id, v) in enumerate(rows)]
    whole = [w for w in whole if w[2] is not None]
    made = []
    for at, query_id, q in whole:
        if query_id is None or query_id % divisor:
            continue
        others = [(-sum(a * b for a, b in zip(q, v)), vec_id is None, vec_id) for other, vec_id, v in whole if other != at]
        best = sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:k]
        made += [(query_id, rank + 1, vec_id, -score) for rank, (score, _, vec_id) in enumerate(best)]
    return sorted(made, key=repr)


def _searched(spark, rows, divisor=50, k=5):
    index = topk.write_index(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), scratch_path(spark, "vectors"))
    found = topk.search(index, topk.stored_vectors(index, divisor), k)
    return sorted((tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def _vectors(count, width=24, seed=4):
    rng = np.random.default_rng(seed)
    made = np.float32(rng.normal(0, 0.2, (count, width)))
    made[count // 3 : count // 3 * 2] = made[0]  # a third is one vector
    return [(k, v.tolist()) for k, v in enumerate(made)]


@pytest.mark.parametrize(("elements", "few", "count"), [(1 << 20, 256, 900), (3_000, 4, 900), (1 << 20, 1, 2_500)])
def test_search_equals_brute_force(spark, monkeypatch, elements, few, count):
    monkeypatch.setattr(topk, "BLOCK_ELEMENTS", elements)
    monkeypatch.setattr(topk, "FEW", few)
    rows = _vectors(count)
    assert _searched(spark, rows) == _nearest(rows, 50, 5)


def test_reading_stops_on_proof_and_loses_none(monkeypatch):
    monkeypatch.setattr(topk, "FEW", 1)
    rng = np.random.default_rng(8)
    for spread in (0.0, 0.9, 3.0):
        vectors = (rng.normal(0, 40, (3_000, 32)) + rng.normal(0, 40, 32) * spread * rng.random((3_000, 1))).astype(np.int32)
        row = topk._index_row(0, [topk.pa.array(range(3_000), topk.pa.int64())], [vectors])
        block = topk._Postings(row, 0)
        for query in (vectors[7], vectors[8] * -1, np.zeros(32, np.int32)):
            query = query.astype(np.int64)
            best = topk._Best(5)
            members = block.possible(query, 7, best)
            scores = vectors.astype(np.int64) @ query
            scores[7] = -(10**12)
            assert set(np.flatnonzero(scores >= np.sort(scores)[-5])) <= set(members.tolist())
            if spread == 3.0 and query.any():
                assert len(members) < 3_000


def test_search_of_odd_vectors(spark):
    rows = _vectors(120, 6) + [
        (200, None),
        (250, [0.1, None, 0.2, 0.1, 0.1, 0.1]),
        (300, [0.1, float("nan"), 0.2, 0.1, 0.1, 0.1]),
        (350, [float("inf")] * 6),
        (400, []),
        (450, [1.0, -2.0]),
        (500, [0.5] * 40),
        (550, [0.0] * 6),
        (None, [3.0] * 6),
        (None, [3.0] * 6),
        (600, [2.0] * 6),
        (600, [2.0] * 6),
        (-50, [1000.0, -1000.0, 0.001, 0.0, 0.0, -0.001]),
    ]
    assert _searched(spark, rows) == _nearest(rows, 50, 5)
    assert _searched(spark, rows[:3]) == _nearest(rows[:3], 50, 5)
    assert _searched(spark, rows[:1]) == [] and _searched(spark, [(200, None)]) == []


def test_search_in_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BYTES", 500)
    rows = _vectors(300, 8)
    assert _searched(spark, rows, 10, 3) == _nearest(rows, 10, 3)


def test_search_of_an_empty_table_with_other_columns(spark):
    rows = spark.createDataFrame([(1, [1.0], "a", "b")], "vec_id long, embedding array<double>, score string, block string")
    for frame, count in ((rows.where("false"), 0), (rows.union(rows).union(rows.selectExpr("50", "embedding", "score", "block")), 2)):
        index = topk.write_index(frame, scratch_path(spark, "vectors"))
        assert topk.search(index, topk.stored_vectors(index, 50)).count() == count


# ---- ranked lexical search -------------------------------------------------------


def _ranked(docs, items, k=10):
    held = [(doc_id, collections.Counter(words_of((t or "").encode()))) for doc_id, t in docs]
    sizes = [c.total() for _, c in held]
    n, total = sum(1 for s in sizes if s), sum(sizes)
    df = collections.Counter(w for _, c in held for w in c)
    made = []
    for item_id, text in items:
        found = []
        for (doc_id, counts), size in zip(held, sizes, strict=True):
            if not size:
                continue
            m, score = 25 + 75 * size * n // total, 0
            for word, times in collections.Counter(words_of((text or "").encode())).items():
                if counts[word]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[word] + 1)))
                    score += times * weight * (10**9 * counts[word] // (1000 * counts[word] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        best = sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k]
        made += [(item_id, rank + 1, doc_id, -score) for rank, (score, _, doc_id) in enumerate(best)]
    return sorted(made, key=repr)


def _found(spark, docs, items, k=10):
    got = nra.rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def _library():
    texts = _texts(11, 400, 120)
    docs = [(k, t) for k, t in enumerate(texts)]
    docs += [(1_000 + k, texts[6]) for k in range(200)] + [(None, texts[6]), (None, None), (5, texts[5]), (2_000, "word1 " * 9_000)]
    items = [(k, t) for k, t in enumerate(_texts(12, 30, 150))] + [(3, "Word1 word1 WORD2"), (None, "word7"), (90, None), (91, ""), (92, "unheard")]
    return docs, items


@pytest.mark.parametrize(("postings", "blocks", "k"), [(1 << 20, 1 << 24, 10), (200, 1 << 24, 10), (1 << 20, 3_000, 3)])
def test_ranking_equals_brute_force(spark, monkeypatch, postings, blocks, k):
    monkeypatch.setattr(nra, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(nra, "BLOCK_BYTES", blocks)
    docs, items = _library()
    assert _found(spark, docs, items, k) == _ranked(docs, items, k)


def test_ties_go_to_smaller_ids(spark):
    docs = [(k, "alpha beta") for k in range(40, 0, -1)] + [(k, "gamma") for k in range(100, 140)]
    assert [r[2] for r in sorted(_found(spark, docs, [(1, "beta")]))] == list(range(1, 11))


def test_ranking_over_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([("a", "the fox")], "item_id string, text string")
    assert nra.rank_documents(no_docs, items).count() == 0
    assert nra.rank_documents(odd_docs, items.limit(0)).count() == 0
    found = nra.rank_documents(odd_docs, items).collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in sorted(found, key=lambda r: r["rank"])] == [("a", 1, 1), ("a", 2, 1)]


def test_reading_ends_before_the_lists_do():
    """A document far ahead in all lists is proven best without reading the rest."""
    rows = 2_000
    terms = np.tile(np.arange(3), rows)
    counts = np.ones(rows * 3, np.int64)
    counts[:3] = 50
    shard = nra.Shard(nra.pa.array(range(rows), nra.pa.int64()), np.full(rows, 60), np.full(rows, 3), terms, counts, (rows, rows * 60))
    members, scores = shard.best(np.arange(3), np.array([5, 6, 7]), 1, 1)
    assert members.tolist() == [0] and scores.tolist() == [18 * int(10**9 * 50 // (50_000 + 8 * 100))]
    assert shard.best(np.arange(3), np.array([5, 6, 7]), 1, int(scores[0]) + 1)[0].tolist() == []
