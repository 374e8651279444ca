"""Near duplicates, components, language model, WARC archives."""

import collections
import gzip
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from streetloom.llm import components, eliasfano, lm, neardup, warc
from streetloom.llm.queries import QUERIES
from streetloom.session import scratch_path


# ---- components ------------------------------------------------------------------


def _classes(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components_equal_union_find(spark, shape):
    rng = random.Random(1)
    edges = {
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        "chain": [(k, k + 1) for k in range(60)],
        "star": [(k, 500) for k in range(100)] + [(3, 3), (4, 500)],
        "none": [],
    }[shape]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    want = {x: c for x, c in _classes(edges).items() if x != c}
    assert {r["node"]: r["label"] for r in got.collect()} == want


# ---- near duplicates -------------------------------------------------------------


def _near(rows):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        width = min(3, len(words))
        sets[doc_id] = frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if words else frozenset()
    ids = sorted(sets)
    edges = [(i, i) for i in ids]
    for at, i in enumerate(ids):
        for j in ids[:at]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                edges.append((j, i))
    return {i: (len(sets[i]), c) for i, c in _classes(edges).items()}


def _edited_copies():
    """Families of copies with more and more edits, so that similarities lie on both sides of the threshold."""
    rng = random.Random(9)
    rows = []
    for family in range(6):
        words = [f"w{rng.randrange(4_000)}" for _ in range(rng.choice([4, 30, 120]))]
        for _ in range(25):
            copy = list(words)
            for _ in range(rng.randrange(0, max(1, len(words) // 12) + 1)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, " \n", "one", "ONE", "one two", "one two three", "One\tTwo\nthree"])]
    return rows


def test_classes_equal_brute_force(spark):
    rows = _edited_copies()
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == _near(rows)


@pytest.mark.parametrize(("name", "limit"), [("BLOCK", 7), ("BLOCK_ELEMENTS", 300)])
def test_classes_do_not_depend_on_blocks(spark, monkeypatch, name, limit):
    rows = _edited_copies()
    monkeypatch.setattr(neardup, name, limit)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {i: c for i, (_, c) in _near(rows).items()}


def test_classes_of_real_documents(sample):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    got = neardup.near_duplicates(sample)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == _near(rows)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(3)
    for shared in (20, 60, 180):
        agree = []
        for _ in range(40):
            elements = rng.integers(0, 2**63, 400 - shared, dtype=np.uint64)
            first, second = elements[:200], elements[200 - shared :]
            agree.append((neardup.sketch(first) == neardup.sketch(second)).mean())
        assert np.mean(agree) == pytest.approx(shared / (400 - shared), abs=0.04)
    for size in (1, 2, 7, 119, 5_000):
        assert len(neardup.sketch(rng.integers(0, 2**63, size, dtype=np.uint64))) == neardup.BINS


def test_near_duplicates_of_odd_and_empty_tables(spark, odd_docs, no_docs):
    got = collections.Counter(tuple(r) for r in neardup.near_duplicates(odd_docs).collect())
    assert sum(got.values()) == odd_docs.count()
    assert got[(1, 10, 1)] == 2 and got[(2, 0, 2)] == 1 and got[(None, 0, None)] == 1
    both = spark.createDataFrame([(None, "a b c"), (8, "a b c"), (None, "x y z")], "doc_id long, text string")
    assert sorted(map(str, (tuple(r) for r in neardup.near_duplicates(both).collect()))) == ["(8, 1, 8)", "(None, 1, 8)", "(None, 1, None)"]
    kept = neardup.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1  # of the two equal rows one goes
    assert sorted(map(str, (tuple(r) for r in neardup.keep_one_of_each(both).collect()))) == ["(8, 'a b c')", "(None, 'x y z')"]
    assert neardup.near_duplicates(no_docs).count() == 0


ALIKE = "one two three four five six seven eight nine ten"


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([(1, "t a"), (2, "t a"), (2, "u b"), (3, "v c")], [(1, "t a"), (2, "u b"), (3, "v c")]),  # one id on two texts
        ([(1, "t a")] * 3 + [(4, "u b")], [(1, "t a"), (4, "u b")]),  # equal rows
        ([(None, "t a")] * 3 + [(None, "u b")], [(None, "t a"), (None, "u b")]),  # copies without an id
        ([(None, "t a"), (9, "T  A")], [(9, "T  A")]),  # a copy without an id of one with an id
        ([(5, ALIKE), (5, ALIKE + " "), (6, ALIKE)], 5),  # one id on two texts that are alike: one of them
        ([(1, ""), (1, ""), (None, None), (None, None)], [(1, ""), (1, ""), (None, None), (None, None)]),  # no words, no class
        ([(k, "same text here") for k in range(300)] + [(400, "other")], [(0, "same text here"), (400, "other")]),
    ],
)
def test_rows_decide_what_stays(spark, rows, want):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _row string")
    kept = neardup.keep_one_of_each(frame)
    got = [tuple(r)[:2] for r in kept.collect()]
    assert kept.columns == frame.columns
    if isinstance(want, int):
        assert len(got) == 1 and got[0][0] == want
    else:
        assert sorted(got, key=repr) == sorted(want, key=repr)


# ---- language model --------------------------------------------------------------


def test_elias_fano_equals_sorted_search():
    rng = np.random.default_rng(1)
    for n, universe in ((0, 10), (1, 1), (1, 1 << 64), (5, 7), (900, 1 << 64), (900, 1_300), (50_000, 1 << 46), (3_000, 100)):
        values = np.sort(rng.integers(0, min(universe, 2**64 - 1), n, dtype=np.uint64, endpoint=universe == 1 << 64))
        coded = eliasfano.EliasFano(*eliasfano.ef_arrays(values, universe))
        queries = np.concatenate([values, rng.integers(0, min(universe, 2**63), 500, dtype=np.uint64)])
        assert (coded.successor(queries) == np.searchsorted(values, queries)).all()
        found = coded.find(queries)
        assert ((found >= 0) == np.isin(queries, values)).all() and (values[found[found >= 0]] == queries[found >= 0]).all()
        if n:
            places = rng.integers(0, n, 200)
            assert (coded.access(places) == values[places]).all()


def _grams(texts, order):
    """Counts of n-grams over number-free token lists; contexts begin with one end."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for text in texts:
        tokens = (text or "").encode().lower().split() + [b"\n"]
        counts[1].update((t,) for t in tokens)
        padded = [b"\n", *tokens]
        for k in range(2, order + 1):
            counts[k].update(tuple(padded[i : i + k]) for i in range(len(padded) - k + 1))
    return counts


def _chance(gram, counts, followers, total, words):
    k = len(gram)
    if k == 1:
        return (counts[1][gram] + 1) / (total + words + 1)
    lower = _chance(gram[1:], counts, followers, total, words)
    mass, kinds = followers[gram[:-1]]
    if not mass:
        return lower
    return max(counts[k][gram] - lm.DISCOUNT, 0) / mass + lm.DISCOUNT * kinds / mass * lower


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_a_plain_model(sample, order):
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    learn = sample.where("doc_id % 7 <> 2")
    counts = _grams([t for i, t in rows if i % 7 != 2], order)
    total, words = sum(counts[1].values()), len(counts[1])
    followers = collections.defaultdict(lambda: (0, 0))
    for k in range(2, order + 1):
        for gram, n in counts[k].items():
            mass, kinds = followers[gram[:-1]]
            followers[gram[:-1]] = (mass + n, kinds + 1)
    got = {r["doc_id"]: r for r in lm.score(sample, lm.train(learn, order=order)).collect()}
    for doc_id, text in rows:
        tokens = (text or "").encode().lower().split() + [b"\n"]
        padded = [b"\n", *tokens]
        row = got[doc_id]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens), sum(counts[1][(t,)] > 0 for t in tokens), total)
        base = math.fsum(math.log10((counts[1][(t,)] + 1) / (total + words + 1)) for t in tokens)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        want = math.fsum(
            math.log10(_chance(tuple(padded[max(0, at - order + 1) : at + 1]) if order > 1 else (padded[at],), counts, followers, total, words))
            for at in range(1, len(padded))
        )
        assert abs(row["score"] - want) <= 0.05 * len(tokens)  # one byte for each probability


def test_registered_scores_use_contexts_of_two_words(spark, tmp_path):
    texts = {k: "a b c" if k % 2 else "d b e" for k in range(40)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op3_lm"](spark, str(tmp_path)).collect()
    counts = _grams([texts[r["doc_id"]] for r in rows if not r["held_out"]], 3)
    total, words = sum(counts[1].values()), len(counts[1])
    followers = collections.defaultdict(lambda: (0, 0))
    for k in (2, 3):
        for gram, n in counts[k].items():
            mass, kinds = followers[gram[:-1]]
            followers[gram[:-1]] = (mass + n, kinds + 1)
    for row in rows:
        padded = [b"\n", *texts[row["doc_id"]].encode().split(), b"\n"]
        want = sum(math.log10(_chance(tuple(padded[max(0, at - 2) : at + 1]), counts, followers, total, words)) for at in range(1, len(padded)))
        assert row["score"] == pytest.approx(want, abs=0.02)


def test_pointers_count_followers(spark):
    texts = spark.createDataFrame([(1, "a b a c a b"), (2, "b a")], "doc_id long, text string")
    model = lm.train(texts)
    numbers, counts = model.word_numbers(np.array([lm.WORD_HASHES[w] for w in (b"a", b"b", b"zz")] + [lm.END], np.uint64))
    assert counts.tolist() == [4, 3, 0, 2] and numbers[2] == -1
    # a: b, c, end; b: a, end; end: a, b
    assert model.followers(2, numbers[[0, 1, 3]]).tolist() == [3, 2, 2]


def test_model_of_odd_and_empty_tables(odd_docs, no_docs):
    scored = lm.score(odd_docs, lm.train(odd_docs)).collect()
    assert len(scored) == odd_docs.count() and all(r["n_tokens"] == r["n_known"] for r in scored)
    assert all(r["score"] < 0 for r in scored)
    nothing = lm.train(no_docs)
    assert {(r["train_tokens"], r["score"], r["base_score"]) for r in lm.score(odd_docs, nothing).collect()} == {(0, 0.0, 0.0)}
    assert lm.score(no_docs, nothing).count() == 0


# ---- WARC ------------------------------------------------------------------------

LONG = "<p>" + "payload " * 20 + "</p>"
PAGES = [
    (5, "http://b.example.org/x?q=1", LONG),
    (3, "https://a.example.org:8080/", LONG),
    (3, "https://a.example.org:8080/", LONG),
    (None, "http://b.example.org/x?q=1", LONG),
    (7, None, "short"),
    (8, "http://b.example.org/x?q=1", "short"),
    (9, "http://c.example/line\nbreak é", None),
    (None, "", LONG + "2"),
    (11, "not a url", "é" * 60),
]


@pytest.fixture(scope="module")
def archive(spark):
    folder = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, archive string")
    warc.write_archives(pages.repartition(2), f"{folder}/archives")
    warc.write_index(warc.read_archives(spark, f"{folder}/archives"), f"{folder}/index", block_lines=2)
    return folder


def test_records_of_odd_pages(spark, archive):
    rows = warc.read_archives(spark, f"{archive}/archives").collect()
    got = collections.Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in rows)
    size = len(LONG)
    assert got == collections.Counter([
        (5, "revisit", 3, size), (3, "response", None, size), (3, "response", None, size), (None, "revisit", 3, size),
        (7, "response", None, 5), (8, "response", None, 5), (9, "response", None, 0), (None, "response", None, size + 1), (11, "response", None, 120),
    ])


def test_files_are_plain_gzip(spark, archive):
    content = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").load(f"{archive}/archives").collect())
    text = gzip.decompress(content)
    assert text.count(b"WARC/1.1\r\n") == len(PAGES) and text.count(b"\r\nWARC-Type: revisit\r\n") == 2


def test_index_finds_every_capture(spark, archive):
    index = warc.CaptureIndex(spark, f"{archive}/index")
    keys = [r["key"] for r in warc.read_index(spark, f"{archive}/index").collect()]
    assert len(keys) == len(PAGES) and "org,example,a:8080)/" in keys and "org,example,b)/x?q=1" in keys
    for url in {p[1] for p in PAGES}:
        want = collections.Counter(p[0] for p in PAGES if warc.url_key(p[1]) == warc.url_key(url))
        found = index.captures(url)
        assert collections.Counter(c["page_id"] for c in found) == want, url
        for capture in found:
            record = index.read(capture)
            assert record["page_id"] == capture["page_id"]
            if record["record_type"] == "response":
                assert record["payload"] in {(p[2] or "").encode() for p in PAGES if p[0] == record["page_id"]}
    assert index.captures("http://nowhere.example/") == []


@pytest.mark.parametrize(("rows", "ranges"), [(500_000, 2_000_000), (2, 2_000_000), (1, 0)])
def test_table_of_urls_is_looked_up_through_the_directory(spark, archive, monkeypatch, rows, ranges):
    monkeypatch.setattr(warc, "DIRECTORY_ROWS", rows)
    monkeypatch.setattr(warc, "MAX_BROADCAST_RANGES", ranges)
    for asked in ([p[1] for p in PAGES], [PAGES[0][1], PAGES[0][1], "http://nowhere.example/"], [None], ["http://nowhere.example/"]):
        urls = spark.createDataFrame([(u, "clash") for u in asked], "url string, key string")
        captures = warc.look_up(spark, f"{archive}/index", urls)
        found = warc.read_records(spark, captures, f"{archive}/archives").collect()
        want = collections.Counter(p[0] for p in PAGES if warc.url_key(p[1]) in {warc.url_key(u) for u in asked})
        assert collections.Counter(r["page_id"] for r in found) == want
        every = {(r["archive"], r["offset"]): r for r in warc.read_archives(spark, f"{archive}/archives").collect()}
        assert all(every[(r["archive"], r["offset"])] == r for r in found)


def test_a_wrong_directory_shows(spark, archive):
    """Rows come through the directory: an entry that is lost loses rows, one that points elsewhere fails."""
    folder = scratch_path(spark, "warc-wrong")
    warc.write_index(warc.read_archives(spark, f"{archive}/archives"), folder, block_lines=2)
    urls = spark.createDataFrame([(p[1],) for p in PAGES], "url string")
    entries = spark.read.parquet(f"{folder}/directory").collect()
    assert len(entries) > 2 and warc.look_up(spark, folder, urls).count() == len(PAGES)
    columns = "first_key string, file string, offset bigint, length bigint"
    spark.createDataFrame(sorted(entries)[:-1], columns).write.mode("overwrite").parquet(f"{folder}/directory")
    assert warc.look_up(spark, folder, urls).count() < len(PAGES)
    moved = [(e["first_key"], e["file"], e["offset"] + 1, e["length"]) for e in entries]
    spark.createDataFrame(moved, columns).write.mode("overwrite").parquet(f"{folder}/directory")
    with pytest.raises(Exception, match="incorrect header"):
        warc.look_up(spark, folder, urls)


def test_empty_archives(spark):
    folder = scratch_path(spark, "warc-empty")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{folder}/archives")
    records = warc.read_archives(spark, f"{folder}/archives")
    assert records.count() == 0
    warc.write_index(records, f"{folder}/index")
    assert warc.read_index(spark, f"{folder}/index").count() == 0
    assert warc.CaptureIndex(spark, f"{folder}/index").captures("http://a.example/") == []
    urls = spark.createDataFrame([("http://a.example/",)], "url string")
    assert warc.read_records(spark, warc.look_up(spark, f"{folder}/index", urls), f"{folder}/archives").count() == 0


def test_key_order_keeps_a_site_together():
    assert warc.url_key("http://User@WWW.Example.org/a") == "org,example,www)/a"
    assert warc.url_key(None) == "" and " " not in warc.url_key("http://a.example/b c")
