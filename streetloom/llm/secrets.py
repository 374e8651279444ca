"""Secret scans: an Aho-Corasick automaton finds keywords, anchored expressions run only at its hits.

Every kind but ``hex`` starts with a keyword, so its expression is tried at hits alone, in order, skipping
hits inside an earlier match of the kind: that equals a left-to-right search without overlaps. Kinds whose tokens
embed a checksum or a decodable header are kept only if it holds. Runs of hex digits have no keyword; they are
maximal runs, found by one linear expression.

Defined results: a null or empty text has no secrets; positions are code points, end exclusive; equal starts
are ordered by the kinds' order in ``KINDS``. Only key columns are carried, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import binascii
import itertools
import json
import re
import zlib
from collections.abc import Sequence
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.llm.common import column_schema, map_batches, replace_column

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE_KINDS = KINDS[:3]
MARK = "[SECRET]"
_ORDER = {kind: at for at, kind in enumerate(KINDS)}
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_WORD_START = {
    "access": ("AKIA",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "jwt": ("eyJ",),
    "pem": ("-----BEGIN ",),
}


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


_EXPRESSIONS = {
    "assign": "(?:" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token"))
    + "|" + _any_case("api") + "_?" + _any_case("key")
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "github": "gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])",
    "npm": "npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])",
    "jwt": r"(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*",
    "pem": r"-----BEGIN ([A-Z ]*)PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END \1PRIVATE KEY-----",
}
_PATTERNS = {kind: re.compile(pattern, re.ASCII) for kind, pattern in _EXPRESSIONS.items()}
_HEX = re.compile("[0-9a-f]{32,}")
_JWT_RUN = re.compile("[A-Za-z0-9_-]+")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def token_checksum(body: str) -> str:
    """Six base-62 digits of the CRC-32, as such tokens carry them at their end."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits.rjust(6, "0")


def _json_header(part: str) -> bool:
    try:
        header = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header


def _holds(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[1]) >= 8
    if kind == "access":
        return len(match[0]) >= 16
    if kind in ("github", "npm"):
        return token_checksum(match[1][:30]) == match[1][30:]
    return _json_header(match[1]) if kind == "jwt" else True


@cache
def _automaton() -> ahocorasick.Automaton:
    """Keywords to kinds; every mixture of letter cases of the assign words is a keyword of its own."""
    automaton = ahocorasick.Automaton()
    for word in _ASSIGN_WORDS:
        for spelt in itertools.product(*({c.upper(), c.lower()} for c in word)):
            automaton.add_word("".join(spelt), ("assign", len(word)))
    for kind, words in _WORD_START.items():
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def find_secrets(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start and kind."""
    if not text:
        return []
    spans, ends = [], {}
    for last, (kind, size) in _automaton().iter(text):
        start = last - size + 1
        if start < ends.get(kind, 0):
            continue
        match = _PATTERNS[kind].match(text, start)
        if match:
            ends[kind] = match.end()
            if _holds(kind, match):
                spans.append((start, match.end(), kind))
        elif kind == "jwt":  # what follows the run decides, so no later hit in it can match
            ends[kind] = _JWT_RUN.match(text, start).end()
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], _ORDER[s[2]]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan_secrets(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys`` and spans, an array of (kind, start, end)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": k, "start": a, "end": b} for a, b, k in find_secrets(t)]
            for t in batch.column("_text").to_pylist()
        ]
        return pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(spans, _SPANS)], [*keys, "spans"])

    head = column_schema(docs.select(*keys))
    read = docs.select(*keys, F.col(text).alias("_text"))
    return map_batches(read, work, f"{head}, spans array<struct<kind:string,start:int,end:int>>")


def mask_secrets(docs: DataFrame, text: str = "text", mark: str = MARK) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; overlapping secrets become one mark."""

    def masked(content: str | None) -> str | None:
        parts, at, done = [], 0, 0
        for start, end, _ in find_secrets(content):
            if start >= done:
                parts += [content[at:start], mark]
            at = done = max(done, end)
        return "".join([*parts, content[at:]]) if parts else content

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return replace_column(batch, text, pa.array([masked(t) for t in batch.column(text).to_pylist()], pa.string()))

    return map_batches(docs, work, column_schema(docs))
