"""Training-data pipeline over ``documents``: each stage is written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.common import documents
from streetloom.llm.decontaminate import remove_hits
from streetloom.llm.neardup import keep_one_of_each
from streetloom.llm.pieces import encode_texts
from streetloom.llm.queries import tokenizer_file
from streetloom.llm.rules import keep_documents
from streetloom.llm.secrets import mask_secrets
from streetloom.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _recounted(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or a certified cutoff go."""
    return keep_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents (runs of five words, 80 %) the one with the smallest id stays."""
    return keep_one_of_each(docs, size=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    return _recounted(remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _recounted(mask_secrets(docs))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text that is left, their number, and the text they decode to."""
    coded = encode_texts(docs, tokenizer_file())
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("piece_encoding", piece_encoding),
]

#: The stages hold learned thresholds and a tokenizer, which SQL cannot state; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
