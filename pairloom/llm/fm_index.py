"""A word-level FM-index: wavelet-matrix ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; symbol 0 is a separator, each one unequal to all others.

    Ranks double in depth each round, and only suffixes still tied are sorted again. The last
    symbol must be 0, so that no comparison runs off the end.
    """
    n = len(symbols)
    gaps = symbols == 0
    start = np.where(gaps, np.cumsum(gaps) - 1, symbols.astype(np.int64) + int(gaps.sum()))
    bits = int(start.max()).bit_length() + 1
    depth = max(1, 63 // bits)
    key = start.copy()
    for k in range(1, depth):
        key <<= bits
        key[: max(n - k, 0)] += start[k:]
    order = np.argsort(key)
    ahead = np.ones(n + 1, dtype=bool)
    ahead[1:n] = np.diff(key[order]) != 0
    at = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(ahead[:n], at, 0))
    tied = at[~(ahead[:n] & ahead[1:])]
    while len(tied):
        suffix = order[tied]
        key = (rank[suffix] << 32) | rank[suffix + depth]
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[tied] = suffix
        ahead = np.ones(len(tied) + 1, dtype=bool)
        ahead[1:-1] = np.diff(key) != 0
        rank[suffix] = np.maximum.accumulate(np.where(ahead[:-1], tied, 0))
        tied = tied[~(ahead[:-1] & ahead[1:])]
        depth *= 2
    return order


class Bits:
    """A bit vector with counts of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """Index of one shard of documents, each ended by a separator (symbol 0)."""

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        n = len(symbols)
        suffixes = suffix_array(symbols)
        last = symbols[suffixes - 1]
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        self.levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(max(1, int(symbols.max()).bit_length()))):
            ones = (last >> level) & 1 != 0
            zeros = n - int(ones.sum())
            self.levels.append((level, Bits(ones), zeros))
            last = np.concatenate([last[~ones], last[ones]])
        # Walks to the left end at a sampled position: every few, and each document's first.
        begins = np.zeros(n, dtype=bool)
        begins[::sample] = True
        begins[np.flatnonzero(symbols == 0)[:-1] + 1] = True
        kept = begins[suffixes]
        self.sampled, self.positions = Bits(kept), suffixes[kept]
        self.size = n

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1 != 0, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the first ``at`` places of the transform."""
        return self._down(symbol, at) - self._down(symbol, np.zeros_like(at))

    def _left(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix that is one word longer; not for a document's first word."""
        symbol, at = np.zeros_like(rows), rows
        for level, bits, zeros in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            symbol = symbol | (one.astype(np.int64) << level)
            at = np.where(one, zeros + ones, at - ones)
        return self.less[symbol] + at - self._down(symbol, np.zeros_like(at))

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each pattern: symbols aligned left in a matrix, -1 for unknown words."""
        low = np.zeros(len(lengths), dtype=np.int64)
        high = np.full(len(lengths), self.size, dtype=np.int64)
        for column in reversed(range(patterns.shape[1])):
            active = np.flatnonzero((lengths > column) & (high > low))
            symbol = patterns[active, column]
            high[active[symbol < 0]] = 0
            active, symbol = active[symbol > 0], symbol[symbol > 0]
            first = self.less[symbol] - self._down(symbol, np.zeros_like(symbol))
            low[active] = first + self._down(symbol, low[active])
            high[active] = first + self._down(symbol, high[active])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by walking left to the next sampled position."""
        out = np.empty(len(rows), dtype=np.int64)
        left, steps, now = np.arange(len(rows)), 0, rows
        while len(left):
            there = self.sampled.get(now)
            out[left[there]] = self.positions[self.sampled.rank(now[there])] + steps
            left, now = left[~there], self._left(now[~there])
            steps += 1
        return out
