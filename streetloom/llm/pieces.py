"""SentencePiece encoding and decoding: exact merge-type (BPE) encoding by backtracking.

A token sequence is what merging would give exactly when each adjacent pair of its tokens is what merging the pair's
own characters gives. So the encoder walks a word from the left with the longest match at each place (one
Aho-Corasick pass), falls back to shorter matches, and drops tokens again where no match fits the one before;
a bitfield keeps the positions from which no continuation exists, so each is tried once.

Texts are cut where no merge can reach: before a word's first space mark, and at characters that are no piece
(those become byte pieces). Runs of space marks have pieces of one equal, lowest score; they merge after
everything else and strictly from the left, so they are encoded apart, by their length.

The model file is only read for its pieces, scores and kinds (``load_pieces``); encoding and decoding are here.
Models are refused that do not meet what the above rests on: BPE scores that differ, space marks only at a
piece's start, byte fallback, no text normalisation.

Defined results: a null or empty text has no ids and decodes to the empty text. Only key columns are carried, so
other columns cannot clash.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetloom.llm.common import column_schema, map_batches

MARK = "▁"  # stands for a space
MAX_PIECES = 1_000_000  # of a vocabulary that may be broadcast
CACHE_WORDS = 200_000  # encoded words of one generation; a Python worker remembers two
CACHE_PAIRS = 500_000  # adjacent pairs it remembers
LONG_WORD = 64  # longer words are not remembered


@dataclass(frozen=True)
class Pieces:
    """A vocabulary as plain values, for a broadcast."""

    name: str
    texts: list[str]
    scores: list[float]
    control: frozenset[int]
    unknown: int
    byte_ids: list[int]


def load_pieces(model_file: str) -> Pieces:
    """Pieces of a model file, checked for the properties that the encoder needs."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.vocab_size()
    if size > MAX_PIECES:
        raise ValueError(f"{size} pieces are too many to broadcast")
    texts = [model.id_to_piece(i) for i in range(size)]
    scores = [model.get_score(i) for i in range(size)]
    bytes_at = {texts[i]: i for i in range(size) if model.is_byte(i)}
    byte_ids = [bytes_at.get(f"<0x{b:02X}>", -1) for b in range(256)]
    control = frozenset(i for i in range(size) if model.is_control(i) or model.is_unused(i))
    plain = [i for i in range(size) if i not in control and i != model.unk_id() and not model.is_byte(i)]
    singles = {texts[i] for i in plain if len(texts[i]) == 1}
    runs = [i for i in plain if not texts[i].strip(MARK)]
    merged = [scores[i] for i in plain if len(texts[i]) > 1 and texts[i].strip(MARK)]
    sound = (
        min(byte_ids) >= 0
        and MARK in singles
        and all(set(texts[i]) <= singles for i in plain)
        and all(MARK not in texts[i][1:] for i in plain if texts[i].strip(MARK))
        and len(set(merged)) == len(merged)
        and len({scores[i] for i in runs if len(texts[i]) > 1}) <= 1
        and min(merged) > max((scores[i] for i in runs if len(texts[i]) > 1), default=float("-inf"))
        and model.decode(model.encode("  ﬁ  １ ")) == "  ﬁ  １ "
    )
    if not sound:
        raise ValueError(f"{model_file} is not a plain merge-type model with byte fallback")
    return Pieces(model_file, texts, scores, control, model.unk_id(), byte_ids)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        special = {*pieces.control, pieces.unknown, *pieces.byte_ids}
        plain = {t: i for i, t in enumerate(pieces.texts) if i not in special}
        self.runs = {len(t): i for t, i in plain.items() if not t.strip(MARK)}
        words = {t: i for t, i in plain.items() if t.strip(MARK) or t == MARK}
        self.score = {t: pieces.scores[i] for t, i in words.items() if len(t) > 1}
        self.known = frozenset(t for t in words if len(t) == 1)
        by_score = sorted(self.score, key=self.score.get, reverse=True)
        self.place = {t: 2 * k for k, t in enumerate(by_score)}  # order of merges; doubled to tell sides apart
        self.halves: dict[str, tuple[str, str]] = {}
        # a piece that merging its own characters does not give can never come out
        self.ids = {t: i for t, i in words.items() if self._merges(t)}
        self.shorter = {t: next((t[:k] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), None) for t in self.ids}
        self.matcher = ahocorasick.Automaton()
        for text in self.ids:
            if len(text) > 1:
                self.matcher.add_word(text, (len(text) - 1, text))
        self.matcher.make_automaton()
        breaks = "".join(re.escape(c) for c in "\t\n\r" if c not in self.known)
        self.cut = re.compile(f"{MARK}+[^{MARK}{breaks}]*|[^{MARK}{breaks}]+" + (f"|[{breaks}]" if breaks else ""))
        self.alien = re.compile("([^" + "".join(map(re.escape, sorted(self.known))) + "])")
        self.raw = [t.replace(MARK, " ").encode() for t in pieces.texts]
        for at in pieces.control:
            self.raw[at] = b""
        self.raw[pieces.unknown] = " ⁇ ".encode()
        for byte, at in enumerate(pieces.byte_ids):
            self.raw[at] = bytes([byte])
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.run_ids: dict[int, list[int]] = {}

    def _merges(self, text: str) -> bool:
        """Whether merging a piece's characters plainly, best score first and leftmost of equals, gives the
        piece; its last merge is kept."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = float("-inf"), -1
            for k in range(len(parts) - 1):
                found = score.get(parts[k] + parts[k + 1])
                if found is not None and found > best:
                    best, at = found, k
            if at < 0:
                return False
            if len(parts) == 2:
                self.halves[text] = (parts[0], parts[1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    def _fit(self, left: str, right: str) -> bool:
        """Whether merging again what both hold gives the two back.

        The merges at the border are replayed from the last to the first: undoing the later of the two that made
        what now touches the border, any piece across it must not come before the merge just undone. Among equal
        scores the leftmost comes first: after those on the left, before those on the right.
        """
        pair = (left, right)
        place, halves = self.place, self.halves
        limit, known = 1 << 60, True
        while True:
            across = place.get(left + right)
            if across is not None and across < limit:
                known = False
                break
            a, b = place.get(left, -1), place.get(right, -1)
            if a < 0 and b < 0:
                break
            if a > b:
                limit, left = a, halves[left][1]
            else:
                limit, right = b + 1, halves[right][0]
        if len(self.fits) >= CACHE_PAIRS:
            self.fits.clear()
        self.fits[pair] = known
        return known

    def _backtrack(self, text: str) -> list[str]:
        """Tokens of a text of known characters without inner space marks."""
        if text in self.ids:
            return [text]
        size = len(text)
        longest = list(text)
        for last, (back, token) in self.matcher.iter(text):
            longest[last - back] = token  # of one start, longer ones end later
        dead = bytearray((size >> 3) + 1)
        fits, shorter = self.fits, self.shorter
        tokens: list[str] = []
        at, token, before = 0, longest[0], None
        while True:
            while token is not None:
                end = at + len(token)
                if not dead[end >> 3] >> (end & 7) & 1:
                    if before is None:
                        break
                    fit = fits.get((before, token))
                    if self._fit(before, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token is None:
                dead[at >> 3] |= 1 << (at & 7)
                token = shorter[tokens.pop()]
                at -= len(before)
                before = tokens[-1] if tokens else None
                continue
            tokens.append(token)
            at = end
            if at == size:
                return tokens
            before, token = token, longest[at]

    def _run(self, size: int) -> list[int]:
        """Ids of a run of space marks: equal scores, so always the leftmost merge."""
        if size == 0:
            return []
        if size in self.run_ids:
            return self.run_ids[size]
        length = [1] * size
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        agenda = [(k, 1, 1) for k in range(size - 1)] if 2 in self.runs else []
        while agenda:
            left, first, second = heapq.heappop(agenda)
            right = after[left]
            if length[left] != first or right >= size or length[right] != second:
                continue
            length[left] += second
            length[right] = 0
            after[left] = after[right]
            if after[right] < size:
                before[after[right]] = left
            for a in (before[left], left):
                b = after[a] if a >= 0 else size
                if b < size and length[a] + length[b] in self.runs:
                    heapq.heappush(agenda, (a, length[a], length[b]))
        ids = [self.runs[n] for n in length if n]
        if len(self.run_ids) < 10_000:
            self.run_ids[size] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """Ids, as little-endian 32-bit numbers, of space marks followed by a text without any."""
        rest = word.lstrip(MARK)
        marks = len(word) - len(rest)
        ids: list[int] = []
        pending = marks  # space marks not yet written
        if rest:
            pending = max(0, marks - 1)
            body = word[pending:]
            for part in self.alien.split(body) if self.alien.search(body) else (body,):
                if not part:
                    continue
                if len(part) == 1 and part not in self.known:
                    found = [self.pieces.byte_ids[b] for b in part.encode()]
                else:
                    tokens = self._backtrack(part)
                    if not ids and marks and tokens[0] == MARK:  # the last mark stayed alone and joins its run
                        pending, tokens = marks, tokens[1:]
                    found = [self.ids[t] for t in tokens]
                if not ids:
                    ids = list(self._run(pending))
                    pending = 0
                ids += found
        ids = ids or self._run(pending)
        return struct.pack(f"<{len(ids)}i", *ids)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        words, out = self.words, []
        for word in self.cut.findall(MARK + text.replace(" ", MARK)):
            ids = words.get(word)
            if ids is None:
                ids = self.older.get(word)
                if ids is None:
                    ids = self._word(word)
                if len(word) <= LONG_WORD:
                    if len(words) >= CACHE_WORDS:  # frequent words come back from the older generation
                        self.older = words
                        words = self.words = {}
                    words[word] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; of a byte that is not UTF-8 comes the replacement character."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if i not in self.pieces.control), None)
        if first is not None and self.pieces.texts[first].startswith(MARK):  # of the space put before the text
            raw = raw[1:]
        return raw.decode("utf-8", "one-by-one")


codecs.register_error("one-by-one", lambda error: ("�", error.start + 1))
_CODECS: dict[str, Codec] = {}


def codec(pieces: Pieces) -> Codec:
    """One codec for each Python worker and vocabulary."""
    if pieces.name not in _CODECS:
        _CODECS[pieces.name] = Codec(pieces)
    return _CODECS[pieces.name]


def encode_texts(docs: DataFrame, model_file: str, keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keys``, ids (array<int>) and decoded, the text that the ids decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model_file))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = codec(shared.value)
        coded = [tool.encode(t) for t in batch.column("_text").to_pylist()]
        offsets = np.concatenate(([0], np.cumsum([len(c) // 4 for c in coded]))).astype(np.int32)
        flat = b"".join(coded)
        values = pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)])
        ids = pa.ListArray.from_arrays(pa.array(offsets), values)
        decoded = [tool.decode(np.frombuffer(c, "<i4").tolist()) for c in coded]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keys), ids, pa.array(decoded, pa.string())], [*keys, "ids", "decoded"]
        )

    head = column_schema(docs.select(*keys))
    return map_batches(docs.select(*keys, F.col(text).alias("_text")), work, f"{head}, ids array<int>, decoded string")
