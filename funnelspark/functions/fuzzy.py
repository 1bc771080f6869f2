"""Name similarity from 0 to 100, all built-in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters that one long holds with a bit to spare for the carry.
_WORD = 62


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once: a lambda computes what it mentions anew for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def _letters(text: Column) -> Column:
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substring(text, i, F.lit(1)))


def _word_steps(short: Column, other: Column) -> Column:
    """Common subsequence length, ``short`` of at most ``_WORD`` letters: one machine-word step per letter of the other text."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def mask(letters: Column, letter: Column) -> Column:
        """Bits of the places where the letter stands."""
        begin = F.struct(zero.alias("mask"), one.alias("bit"))
        add = lambda s, x: F.struct((s.mask + F.when(x == letter, s.bit).otherwise(zero)).alias("mask"), (s.bit * 2).alias("bit"))
        return F.aggregate(letters, begin, add, lambda s: s.mask)

    def table(letters: Column) -> Column:
        known = F.array_distinct(letters)
        full = F.aggregate(letters, zero, lambda s, _: 2 * s + 1)
        return F.struct(known.alias("known"), F.transform(known, lambda x: mask(letters, x)).alias("masks"), full.alias("full"), F.size(letters).alias("size"))

    def walk(t: Column) -> Column:
        def step(row: Column, letter: Column) -> Column:
            hit = row.bitwiseAND(F.coalesce(F.get(t.masks, (F.array_position(t.known, letter) - 1).cast("int")), zero))
            return (row + hit).bitwiseOR(row - hit).bitwiseAND(t.full)

        return t.size - F.bit_count(F.aggregate(_letters(other), t.full, step))

    return _let(_let(_letters(short), table), walk)


def _row_steps(a: Column, b: Column) -> Column:
    """The same for two long texts, one row of the table per letter of ``b``."""

    def walk(letters: Column) -> Column:
        def step(row: Column, y: Column) -> Column:
            def cell(made: Column, i: Column) -> Column:
                same = F.get(letters, i - 1) == y
                return F.concat(made, F.array(F.when(same, F.get(row, i - 1) + 1).otherwise(F.greatest(F.get(row, i), F.get(made, i - 1)))))

            return F.aggregate(F.sequence(F.lit(1), F.size(letters)), F.array(F.lit(0)), cell)

        return F.element_at(F.aggregate(_letters(b), F.transform(F.sequence(F.lit(0), F.size(letters)), lambda _: F.lit(0)), step), -1)

    return _let(_letters(a), walk)


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts, in code points; NULL where one is NULL."""
    m, n = F.length(a), F.length(b)
    found = (
        F.when((m <= n) & (m <= _WORD), _word_steps(a, b)).when(n <= _WORD, _word_steps(b, a)).otherwise(_row_steps(a, b))
    )
    return F.when(a.isNotNull() & b.isNotNull(), found)


def name_ratio(a: Column, b: Column, mode: str = "indel") -> Column:
    """Similarity of two texts.

    ``indel``: 200 times the longest common subsequence over the summed lengths.
    ``levenshtein``: 100 times one minus the edit distance over the longer length.
    """
    if mode == "levenshtein":
        longest = F.greatest(F.length(a), F.length(b))
        return F.when(longest == 0, F.lit(100.0)).otherwise(100.0 * (1 - F.levenshtein(a, b) / longest))
    total = F.length(a) + F.length(b)
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * common_length(a, b) / total)
