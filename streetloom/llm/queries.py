"""Registered queries of this subpackage: thin, digest columns derived from the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm import decontaminate, lm, neardup, nra, pieces, pii, quality, resampling, rules, secrets, topk, toxicity, warc
from streetloom.llm.common import documents, held_out, hex_sha256, joined_spans
from streetloom.session import checkpointed, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def _span_columns(spans: Column, kinds: tuple[str, ...]) -> list[Column]:
    """n_<kind> of the base kinds, their digest, and all spans."""
    counts = [F.size(_of_kinds(spans, (k,))).cast("long").alias(f"n_{k}") for k in kinds]
    base = hex_sha256(joined_spans(_of_kinds(spans, kinds)))
    return [*counts, base.alias("base_sha256"), joined_spans(spans).alias("spans")]


def _verdicts(scored: DataFrame, apart: Column, threshold: float) -> DataFrame:
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@register
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    apart = held_out(F.col("doc_id"), 3, 1)
    return _verdicts(quality.score(docs, quality.train(docs, labels, ~apart)), apart, 0.5)


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    apart = held_out(F.col("doc_id"), 4, 2)
    return _verdicts(toxicity.score(docs, toxicity.train(docs, labels, ~apart)), apart, 0.3)


@register
def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    apart = held_out(F.col("doc_id"), 7, 2)
    scored = lm.score(docs, lm.train(docs.where(~apart)))
    return scored.select("doc_id", apart.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(documents(spark, sf_dir))
    counts = [F.size(_of_kinds(F.col("base"), (k,))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    base = hex_sha256(joined_spans(F.col("base")))
    return found.select("doc_id", *counts, base.alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def tokenizer_file() -> str:
    """Place of the vocabulary; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode_texts(documents(spark, sf_dir), tokenizer_file())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        hex_sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@register
def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = neardup.near_duplicates(documents(spark, sf_dir))
    return classes.select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@register
def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # measured once and written, as the cutoffs and the verdicts both read it
    measured = checkpointed(rules.measure(documents(spark, sf_dir), carry=["doc_id"]))
    judged = rules.judge(measured, rules.fit_cutoffs(measured, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    counts = [F.col("_m")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select(F.col("_row")["doc_id"].alias("doc_id"), *counts, "base_failed", "kept")


@register
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(documents(spark, sf_dir))
    return found.select("doc_id", *_span_columns(F.col("spans"), secrets.BASE_KINDS))


@register
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    warc.write_archives(pages, f"{folder}/archives")
    warc.write_index(warc.read_archives(spark, f"{folder}/archives"), f"{folder}/index")
    captures = warc.look_up(spark, f"{folder}/index", pages)
    return warc.read_records(spark, captures, f"{folder}/archives").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    scanned = decontaminate.scan_windows(documents(spark, sf_dir), benchmark)
    size = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    items = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        size.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        hex_sha256(items).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@register
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@register
def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = topk.write_index(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), scratch_path(spark, "vectors"))
    return topk.search(index, topk.stored_vectors(index, 50), 5).select("query_id", "rank", "vec_id", "score")


@register
def op13_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return nra.rank_documents(documents(spark, sf_dir), benchmark, 10).select("item_id", "rank", "doc_id", "score")
