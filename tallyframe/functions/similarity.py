"""String similarity from 0 to 100 as JVM-side column expressions.

The score is `round(100 * 2 * LCS / (len(a) + len(b)))`, half to even, where LCS is the longest
common subsequence. Its length comes from the bit-parallel recurrence of Crochemore et al.
(2001): one addition per character on as many bits as the other text has characters. They
are kept in 62-bit words, and the carry of an addition goes on into the next word.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bits of a word: one is left for the carry and one for the sign.
WORD_CHARS = 62


def characters(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.split(text, "")).otherwise(
        F.array().cast("array<string>")
    )


def _shift(value, by) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("bigint"), by.cast("int"))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, also where `body` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _words(size: Column) -> Column:
    """The numbers of the words that hold `size` bits, from 0; at least one."""
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((size - 1) / WORD_CHARS).cast("int")))


def match_masks(text: Column) -> Column:
    """Map from each character to the bit set of its positions in `text`, as an array of words.

    Build it once per distinct name.
    """
    chars = characters(text)
    positions = F.transform(chars, lambda c, i: F.struct(c.alias("c"), i.alias("i")))

    def mask(char: Column) -> Column:
        at = F.filter(positions, lambda p: p["c"] == char)
        words = F.transform(_words(F.length(text)), lambda w: F.aggregate(
            F.filter(at, lambda p: F.floor(p["i"] / WORD_CHARS) == w), F.lit(0).cast("bigint"),
            lambda acc, p: acc.bitwiseOR(_shift(1, p["i"] - w * WORD_CHARS))))
        return F.struct(char.alias("key"), words.alias("value"))

    return F.map_from_entries(F.transform(F.array_distinct(chars), mask))


def _hits(text: Column, masks: Column) -> Column:
    """The masks of the characters of `text` that the other text has."""
    return F.filter(
        F.transform(characters(text), lambda c: F.try_element_at(masks, c)), lambda m: m.isNotNull())


def _lcs_by_word(text: Column, masks: Column, size: Column) -> Column:
    full = _shift(1, size) - 1
    state = F.aggregate(
        F.transform(_hits(text, masks), lambda m: m[0]), full,
        lambda v, m: (v + v.bitwiseAND(m))
        .bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(full),
    )
    return size - F.bit_count(state)


def _lcs_by_words(text: Column, masks: Column, size: Column) -> Column:
    nothing = F.struct(F.array().cast("array<bigint>").alias("done"), F.lit(0).cast("bigint").alias("carry"))

    def add(state: Column, mask: Column, full: Column) -> Column:
        """One addition over all words, lowest first."""
        def word(acc: Column, w: Column) -> Column:
            v, m = F.get(state, w), F.get(mask, w)
            total = v + v.bitwiseAND(m) + acc["carry"]
            kept = total.bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(F.get(full, w))
            return F.struct(
                F.concat(acc["done"], F.array(kept)).alias("done"),
                F.call_function("shiftright", total, F.lit(WORD_CHARS)).alias("carry"))

        return F.aggregate(_words(size), nothing, word)["done"]

    full = F.transform(_words(size), lambda w: _shift(1, F.least(F.lit(WORD_CHARS), size - w * WORD_CHARS)) - 1)
    state = _let(full, lambda ones: F.aggregate(_hits(text, masks), ones, lambda v, m: add(v, m, ones)))
    return size - F.aggregate(state, F.lit(0), lambda n, v: n + F.bit_count(v))


def lcs_length(a: Column, b: Column, b_masks: Column) -> Column:
    """LCS length of `a` and `b`, given `match_masks(b)`."""
    return _let(b_masks, lambda masks: (
        F.when(F.length(b) <= WORD_CHARS, _lcs_by_word(a, masks, F.length(b)))
        .when(F.length(a) <= WORD_CHARS,
              _let(match_masks(a), lambda own: _lcs_by_word(b, own, F.length(a))))
        .otherwise(_lcs_by_words(a, masks, F.length(b)))
    ))


def score(a: Column, b: Column, b_masks: Column) -> Column:
    """Similarity 0-100: 0 for a null or one empty side, 100 for equal texts."""
    n, m = F.length(a), F.length(b)
    ratio = F.lit(100) * ((2 * lcs_length(a, b, b_masks)) / (n + m).cast("double"))
    return (
        F.when(a.isNull() | b.isNull(), 0)
        .when(a == b, 100)
        .when((n == 0) | (m == 0), 0)
        .otherwise(F.rint(ratio).cast("int"))
    )


def can_exceed(a: Column, b: Column, threshold: int) -> Column:
    """A bound on lengths alone: no pair that fails it can score above `threshold`.

    The LCS is at most the shorter length, and a rounded score above an integer
    threshold needs a raw value of at least `threshold + 0.5`.
    """
    n, m = F.length(a), F.length(b)
    return F.lit(200) * F.least(n, m) >= F.lit(threshold + 0.5) * (n + m)


def character_counts(text: Column) -> Column:
    """Map from each character of `text` to how often it occurs; build it once per name."""
    chars = characters(text)
    return F.map_from_entries(F.transform(F.array_distinct(chars), lambda c: F.struct(
        c.alias("key"), F.size(F.filter(chars, lambda x: x == c)).alias("value"))))


def counts_can_exceed(a: Column, b: Column, a_counts: Column, b_counts: Column, threshold: int) -> Column:
    """As `can_exceed`, with the characters that both texts have for the shorter length."""
    both = F.aggregate(F.map_entries(a_counts), F.lit(0), lambda n, e: n + F.least(
        e["value"], F.coalesce(F.try_element_at(b_counts, e["key"]), F.lit(0))))
    return F.lit(200) * both >= F.lit(threshold + 0.5) * (F.length(a) + F.length(b))
