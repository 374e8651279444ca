"""Similarity of two short strings as plain column expressions.

The ratio is ``100 * 2 * LCS / (length a + length b)`` with LCS the longest common subsequence. The
LCS is found bit-parallel: one string becomes bit masks per character, the other is folded over a bit
vector, so a pair costs one cheap step per character and no intermediate table. Strings of up to 62
characters need one 64-bit word; longer ones carry over several.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetloom.functions.binding import bind

_BITS = 62  # one word; leaves room for the carry in a signed 64-bit sum
_FULL = (1 << _BITS) - 1


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def characters(col: Column) -> Column:
    return F.split(col, "")


def _positions(piece: Column, ch: Column) -> Column:
    """Bit mask of the places of ``ch`` in an array of at most 62 characters."""
    return F.aggregate(
        F.transform(piece, lambda other, at: F.when(other == ch, at)),
        _long(0),
        lambda mask, at: F.when(at.isNull(), mask).otherwise(
            mask.bitwiseOR(F.call_function("shiftleft", _long(1), at))
        ),
    )


def _masks(letters: Column, of_character) -> Column:
    return F.map_from_entries(
        F.transform(F.array_distinct(letters), lambda ch: F.struct(ch, of_character(ch)))
    )


def short_masks(col: Column) -> Column:
    """map<character, mask> of a text of up to 62 characters; null for a longer one."""
    masks = bind(characters(col), lambda letters: _masks(letters, lambda ch: _positions(letters, ch)))
    return F.when(F.length(col) <= _BITS, masks)


def _short_lcs(masks: Column, other: Column) -> Column:
    def step(vector: Column, hit: Column) -> Column:
        total = vector + vector.bitwiseAND(hit)
        return total.bitwiseAND(_long(_FULL)).bitwiseOR(vector.bitwiseAND(F.bitwise_not(hit)))

    hits = F.transform(characters(other), lambda ch: F.coalesce(F.element_at(masks, ch), _long(0)))
    return F.aggregate(hits, _long(_FULL), step, lambda vector: _BITS - F.bit_count(vector))


def _long_lcs(text: Column, other: Column) -> Column:
    words = F.ceil(F.length(text) / _BITS).cast("int")

    def masks(letters: Column) -> Column:
        pieces = F.transform(
            F.sequence(F.lit(0), words - 1), lambda word: F.slice(letters, word * _BITS + 1, _BITS)
        )
        return bind(
            pieces,
            lambda cut: _masks(letters, lambda ch: F.transform(cut, lambda piece: _positions(piece, ch))),
        )

    def fold(by_character: Column) -> Column:
        def step(vector: Column, ch: Column) -> Column:
            hits = F.element_at(by_character, ch)

            def word_step(state: Column, index: Column) -> Column:
                value = F.get(vector, index)
                hit = F.get(hits, index)
                total = value + value.bitwiseAND(hit) + state["carry"]
                merged = total.bitwiseAND(_long(_FULL)).bitwiseOR(value.bitwiseAND(F.bitwise_not(hit)))
                return F.struct(
                    F.array_append(state["out"], merged).alias("out"),
                    F.shiftright(total, _BITS).alias("carry"),
                )

            advanced = F.aggregate(
                F.sequence(F.lit(0), words - 1),
                F.struct(F.array().cast("array<bigint>").alias("out"), _long(0).alias("carry")),
                word_step,
                lambda state: state["out"],
            )
            return F.when(hits.isNull(), vector).otherwise(advanced)

        return F.aggregate(
            characters(other),
            F.array_repeat(_long(_FULL), words),
            step,
            lambda vector: F.aggregate(
                vector, F.lit(0), lambda found, value: found + _BITS - F.bit_count(value)
            ),
        )

    return bind(bind(characters(text), masks), fold)


def measured_ratio(left: Column, right: Column, left_masks: Column | None = None) -> Column:
    """0..100 of two texts that are not empty; ``left_masks`` are the short masks of ``left`` if at hand."""
    if left_masks is None:
        short = bind(short_masks(left), lambda masks: _short_lcs(masks, right))
    else:
        short = _short_lcs(left_masks, right)
    lcs = F.when(F.length(left) <= _BITS, short).otherwise(_long_lcs(left, right))
    return F.bround(lcs * 200 / (F.length(left) + F.length(right))).cast("int")


def similarity_ratio(left: Column, right: Column) -> Column:
    """0..100 on the two texts as given; equal texts (also two empty ones) give 100, one empty gives 0."""
    return (
        F.when(left == right, F.lit(100))
        .when((F.length(left) == 0) | (F.length(right) == 0), F.lit(0))
        .otherwise(measured_ratio(left, right))
    )
