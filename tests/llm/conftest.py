import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_DIR = "/root/testdata/sf0.001"
CLASHING = ("ids", "hits", "items", "spans", "score", "node", "label", "group", "_text", "_row", "_m", "base", "kept", "row", "n")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like the operators' own."""
    long_text = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again.", "en"),
        (1, "The quick brown fox jumps over the lazy dog again and again.", "en"),
        (2, None, "en"),
        (3, "", None),
        (4, " \t\n\r\x0b\x0c ", "en"),
        (None, "a text without an id, token = 'abcdefgh12345678' and a@b.example", "de"),
        (5, long_text, "en"),
        (6, "é" * 20_000, None),
        (7, "x" * 30_000, "fr"),
        (None, None, None),
    ]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASHING)) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")
