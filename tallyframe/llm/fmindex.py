"""An FM-index over a sequence of symbols: suffix array, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np

#: Every so many text positions a suffix keeps its position.
SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of `text`, whose zeros are terminators.

    Each zero is its own symbol (an earlier one is smaller) and `text` ends with
    one, so comparisons end there. Prefix doubling, on the unresolved suffixes only.
    """
    n = len(text)
    ends = text == 0
    start = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + int(ends.sum()) - 1)
    order = np.argsort(start, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = _group_starts(start[order])
    step, open_at = 1, order
    while True:
        groups = rank[open_at]
        same = np.zeros(len(open_at), bool)
        same[1:] = groups[1:] == groups[:-1]
        same[:-1] |= same[1:]
        open_at = open_at[same]
        if not len(open_at):
            break
        groups = rank[open_at]
        # a suffix that is still open has no terminator in its first `step` symbols
        by = np.lexsort((rank[open_at + step], groups))
        open_at, groups = open_at[by], groups[by]
        follow = rank[open_at + step]
        old = np.r_[True, groups[1:] != groups[:-1]]
        new = old | np.r_[True, follow[1:] != follow[:-1]]
        at = np.arange(len(open_at))
        first_old = np.maximum.accumulate(np.where(old, at, 0))
        first_new = np.maximum.accumulate(np.where(new, at, 0))
        rank[open_at] = groups + first_new - first_old
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def _group_starts(values: np.ndarray) -> np.ndarray:
    new = np.r_[True, values[1:] != values[:-1]]
    return np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))


class Bits:
    """A bit vector with rank in constant time: words of 64 bits and running counts."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)

    def at(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletMatrix:
    """rank and access over symbols below 2^depth, one bit vector per level."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.levels, self.zeros = [], []
        self.depth = depth
        for level in range(depth - 1, -1, -1):
            bits = (symbols >> level) & 1 == 1
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.r_[symbols[~bits], symbols[bits]]

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of symbols[i] before position at[i]."""
        start, end = np.zeros_like(at), at
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbols >> (self.depth - 1 - k)) & 1 == 1
            s, e = bits.ones(start), bits.ones(end)
            start, end = np.where(one, zeros + s, start - s), np.where(one, zeros + e, end - e)
        return end - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbols = np.zeros_like(at)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            one, ones = bits.at(at), bits.ones(at)
            symbols = 2 * symbols + one
            at = np.where(one, zeros + ones, at - ones)
        return symbols


class FMIndex:
    """Counts and locates patterns of non-zero symbols in a text of terminated runs."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.rows = len(text)
        order = suffix_array(text)
        last = text[order - 1]  # the symbol before each suffix; the text is a ring
        self.wavelet = WaveletMatrix(last, max(1, int(symbols).bit_length()))
        counts = np.bincount(text, minlength=symbols + 1)
        self.below = np.cumsum(counts) - counts
        # rows that know their position: every SAMPLE-th, and those a step back from
        # which would cross a terminator
        known = (order % SAMPLE == 0) | (last == 0)
        self.known = Bits(known)
        self.where = order[known]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of suffixes that start with each pattern.

        `patterns` is right-aligned: its last column is the last symbol of each.
        """
        width = patterns.shape[1]
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.rows, np.int64)
        for back in range(1, width + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, width - back]
            low[live] = self.below[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by stepping back to sampled ones."""
        found = np.empty(len(rows), np.int64)
        open_at, steps = np.arange(len(rows)), 0
        while len(open_at):
            known = self.known.at(rows)
            found[open_at[known]] = self.where[self.known.ones(rows[known])] + steps
            rows, open_at = rows[~known], open_at[~known]
            symbol = self.wavelet.access(rows)
            rows = self.below[symbol] + self.wavelet.rank(symbol, rows)
            steps += 1
        return found
