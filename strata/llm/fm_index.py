"""An FM-index over integer symbols in numpy: suffix array, wavelet matrix ranks, backward search, sampled locate."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of ``text`` by prefix doubling; only suffixes that still tie are sorted again.  The last symbol must be unique and smallest."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    value = text[order]
    new = np.ones(n, dtype=bool)
    new[1:] = value[1:] != value[:-1]
    begin = np.flatnonzero(new)
    rank[order] = np.repeat(begin, np.diff(np.append(begin, n)))
    size = np.repeat(np.diff(np.append(begin, n)), np.diff(np.append(begin, n)))
    tied = np.flatnonzero(size > 1)  # places in ``order`` whose group is not a single suffix
    step = 1
    while len(tied):
        suffix = order[tied]
        # a tied suffix is followed by at least ``step`` equal symbols, so suffix + step stays inside the text
        key = rank[suffix] * (n + 1) + rank[suffix + step]
        by = np.argsort(key, kind="stable")
        suffix, key = suffix[by], key[by]
        order[tied] = suffix
        new = np.ones(len(tied), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(tied)))
        rank[suffix] = np.repeat(tied[begin], size)
        tied = tied[np.repeat(size, size) > 1]
        step *= 2
    return order


class Bits:
    """A bit vector with rank: ones before every 64-bit word, and a count within it."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(len(bits) // 64 * 64 + 64, dtype=np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Rank and access over a sequence of symbols, one level of bits for each binary digit."""

    def __init__(self, values: np.ndarray, n_symbols: int):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for d in range(self.depth - 1, -1, -1):
            bits = (values >> d & 1).astype(np.uint8)
            self.levels.append(Bits(bits))
            ones = bits.astype(bool)
            self.zeros.append(int(len(bits) - bits.sum()))
            values = np.concatenate([values[~ones], values[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs among the first ``i`` values."""
        low = np.zeros_like(i)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            a, b = level.rank1(low), level.rank1(i)
            low, i = np.where(one, zeros + a, low - a), np.where(one, zeros + b, i - b)
        return i - low

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i``, and how often it occurs before."""
        symbol, low = np.zeros_like(i), np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros):
            one = level.get(i).astype(bool)
            a, b = level.rank1(low), level.rank1(i)
            low, i = np.where(one, zeros + a, low - a), np.where(one, zeros + b, i - b)
            symbol = symbol << 1 | one
        return symbol, i - low


class FMIndex:
    """Index of one shard's ``text`` (symbols from 1 on); answers many patterns at once."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        text = np.append(text.astype(np.int64), 0)
        sa = suffix_array(text)
        self.n = len(text)
        self.bwt = WaveletMatrix(text[sa - 1], n_symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        kept = sa % sample == 0
        self.marked = Bits(kept.astype(np.uint8))
        self.kept = sa[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges ``[lo, hi)`` of patterns of one length, one a row, by backward search."""
        lo = np.zeros(len(patterns), dtype=np.int64)
        hi = np.full(len(patterns), self.n, dtype=np.int64)
        alive = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, k]
            lo[alive] = self.first[symbol] + self.bwt.rank(symbol, lo[alive])
            hi[alive] = self.first[symbol] + self.bwt.rank(symbol, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
        dead = np.ones(len(patterns), dtype=bool)
        dead[alive] = False
        lo[dead] = hi[dead] = 0
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks: step back until a sampled suffix is met."""
        out, steps = np.zeros(len(rows), dtype=np.int64), 0
        todo, at = np.arange(len(rows)), rows.copy()
        while len(todo):
            hit = self.marked.get(at).astype(bool)
            out[todo[hit]] = self.kept[self.marked.rank1(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                symbol, before = self.bwt.access_rank(at)
                at = self.first[symbol] + before
            steps += 1
        return out
