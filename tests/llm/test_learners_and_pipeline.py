"""Quality and toxicity learners, registered queries, pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, connect
from streetloom.llm import decontaminate, neardup, quality, toxicity
from streetloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TRAIN_DIR = "/root/testdata/sf0.1"


def _auc(scores, truth):
    order = np.argsort(np.argsort(scores))
    truth = np.asarray(truth, bool)
    return (order[truth].mean() - order[~truth].mean()) / len(scores) + 0.5


def _held(spark, name, label):
    scored = entry.queries()[name](spark, TRAIN_DIR).join(spark.read.parquet(f"{TRAIN_DIR}/labels.parquet"), "doc_id")
    rows = scored.where("held_out").select("score", "predicted", F.col(label).alias("truth")).collect()
    truth = np.array([r["truth"] for r in rows])
    return np.array([r["score"] for r in rows]), np.array([r["predicted"] for r in rows]), truth


def test_quality_on_held_out_rows(spark):
    scores, predicted, truth = _held(spark, "op1_quality", "quality")
    assert _auc(scores, truth) > 0.97 and (predicted == truth).mean() > 0.93


def test_toxicity_on_held_out_rows(spark):
    scores, predicted, truth = _held(spark, "op2_toxicity", "toxic")
    assert _auc(scores, truth) > 0.95 and (predicted == truth).mean() > 0.96
    assert predicted[truth == 0].mean() < 0.02


def test_prior_is_recovered():
    rng = np.random.default_rng(5)
    for prior in (0.3, 0.6, 0.85):
        good = rng.normal(2, 1, 6_000)
        web = np.where(rng.random(6_000) < prior, rng.normal(2, 1, 6_000), rng.normal(-3, 1, 6_000))
        assert quality.estimate_prior(good, web) == pytest.approx(prior, abs=0.05)


def test_labels_of_held_out_rows_do_not_matter(spark, sample, labels):
    may = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    turned = labels.withColumn("toxic", F.when(may, F.col("toxic")).otherwise(1 - F.col("toxic")))
    first, second = (toxicity.train(sample, known, may) for known in (labels, turned))
    assert first.bias == second.bias and (first.weights == second.weights).all()
    may = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    turned = labels.withColumn("quality", F.when(may, F.col("quality")).otherwise(1 - F.col("quality")))
    first, second = (quality.train(sample, known, may) for known in (labels, turned))
    assert first.prior == second.prior and (first.weights == second.weights).all()


def test_offending_sentences_are_found(spark):
    rng = random.Random(2)
    calm = ["the sun is warm", "we walk home", "tea with milk", "a small boat", "rain on the roof"]
    rows = []
    for k in range(300):
        sentences = [rng.choice(calm) for _ in range(6)]
        if k % 3 == 0:
            sentences[rng.randrange(6)] = f"you are a {rng.choice(['blorg', 'fnark'])} indeed"
        rows.append((k, "é. " + ". ".join(sentences) + ".", int(k % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"), F.lit(True))
    scored = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for doc_id, text, toxic in rows:
        row = scored[doc_id]
        assert (row["score"] >= 0.3) == bool(toxic)
        found = [text[s["start"] : s["end"]] for s in row["offending"]]
        assert all("blorg" in f or "fnark" in f for f in found) and len(found) == toxic


def test_learners_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        model = module.train(odd_docs, labels, F.lit(True))
        scores = [r["score"] for r in module.score(odd_docs, model).collect()]
        assert len(scores) == odd_docs.count() and all(0 <= s <= 1 for s in scores)
        empty = module.train(no_docs, labels.where("false"), F.lit(True))
        assert module.score(no_docs, empty).count() == 0
        assert module.score(odd_docs, empty).count() == odd_docs.count()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_query(spark, con, name):
    verdict = compare(spark, con, SF_DIR, name)
    assert verdict.startswith("ok" if name in entry.oracle_sql() else "rows-only"), verdict


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, last = docs.columns, corpus_pipeline.STAGES[-1][0]
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and docs.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        if name != last:
            assert docs.dtypes == before.dtypes
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "benchmark_decontamination":
            assert decontaminate.scan_windows(docs, benchmark).where("size(hits) > 0").count() == 0
    assert docs.columns == ["doc_id", "n_tokens", "ids", "text"]
    assert docs.where("n_tokens <> size(ids)").count() == 0
    assert sorted(map(str, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(str, docs.collect()))


def test_pipeline_drops_copies_by_five_words_and_80_percent(spark):
    def words(head, n):
        return [f"{head}{k}" for k in range(n)]

    longer, edited = words("a", 200), words("b", 200)
    for k in (20, 60, 100, 140, 180):
        edited[k] = f"new{k}"
    texts = [words("a", 200), longer + words("more", 44), words("b", 200), edited]  # 196 / 240 and 171 / 221 shared
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]


def test_bands_and_agreement_follow_the_asked_similarity():
    assert [(t.bands, t.rows, t.agree) for t in (neardup.Terms(3, 85), neardup.Terms(5, 80))] == [(24, 5, 83), (30, 4, 75)]


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    for number, docs in enumerate((odd_docs, no_docs)):
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
        columns, sizes = docs.columns, [docs.count()]
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}-{name}")
            docs = spark.read.parquet(f"{tmp_path}/{number}-{name}")
            sizes.append(docs.count())
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == columns
        assert sizes == sorted(sizes, reverse=True)
        if number == 0:
            left = [r["doc_id"] for r in docs.collect()]
            # one of two equal rows and one without an id stay; the long text repeats itself throughout
            assert left.count(1) == 1 and None in left and 5 not in left


def test_draw_of_rows_without_ids_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_DRAW", 40)
    drawn = []
    monkeypatch.setattr(quality, "fit", lambda good, web: drawn.append((len(good), len(web))))
    rows = [(None, f"text number {k}") for k in range(900)] + [(k, f"good text {k}") for k in range(900)] + [(7, "the same")] * 900
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1) for k in range(900)], "doc_id long, quality int")
    quality.train(docs, labels, F.coalesce(F.col("doc_id") >= 0, F.lit(True)))
    quality.train(docs.where("doc_id is null"), labels, F.lit(True))
    assert all(n <= 40 for pair in drawn for n in pair) and drawn[0][0] > 10 and drawn[1][0] == 0 and drawn[1][1] > 10
