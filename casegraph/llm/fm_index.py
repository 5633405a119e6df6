"""An FM-index over runs of integer symbols: suffix order, wavelet-tree ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes. Zeros are separators, each smaller than all words and than later
    separators, so no comparison goes beyond a run. Doubling: only positions that are still tied are sorted again."""
    n = len(symbols)
    key = symbols.astype(np.int64)
    gaps = symbols == 0
    key[gaps] = np.arange(int(gaps.sum())) - n
    rank = np.empty(n, dtype=np.int64)
    open_, group, step = np.arange(n), np.zeros(n, dtype=np.int64), 0
    while len(open_):
        if step:
            key = rank[open_ + step]
        order = np.lexsort((key, group))
        at, tie, own = open_[order], key[order], group[order]
        new_group = np.ones(len(at), dtype=bool)
        new_group[1:] = own[1:] != own[:-1]
        new_key = new_group.copy()
        new_key[1:] |= tie[1:] != tie[:-1]
        place = np.arange(len(at))
        start = np.maximum.accumulate(np.where(new_group, place, 0))
        found = own + np.maximum.accumulate(np.where(new_key, place, 0)) - start
        rank[at] = found
        single = new_key.copy()
        single[:-1] &= new_key[1:]
        open_, group = at[~single], found[~single]
        step = step * 2 or 1
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


class WaveletTree:
    """Ranks of symbols in a sequence, one bit level at a time (levels stored as stable partitions)."""

    def __init__(self, sequence: np.ndarray, size: int):
        self.depth = max(1, int(size).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.depth)):
            bit = (sequence >> level) & 1
            sums = np.zeros(len(sequence) + 1, dtype=np.int32)
            np.cumsum(bit, out=sums[1:])
            self.ones.append(sums)
            self.zeros.append(len(sequence) - int(sums[-1]))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])
        symbols = np.arange(size + 1, dtype=np.int64)
        self.begin = self._down(symbols, np.zeros(size + 1, dtype=np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbols >> (self.depth - 1 - k)) & 1
            before = ones[at]
            at = np.where(bit == 1, zeros + before, at - before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbols, at) - self.begin[symbols]


class FMIndex:
    """``symbols`` begins and ends with a separator (zero); words are 1 to ``size``."""

    def __init__(self, symbols: np.ndarray, size: int, every: int = 8):
        order = suffix_order(symbols)
        last = symbols[order - 1]  # the symbol before each suffix; before the first stands the last, a separator
        self.last = last
        self.tree = WaveletTree(last, size)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size + 1))])
        # positions are kept for every few symbols and at the start of each run
        sampled = (order % every == 0) | (last == 0)
        self.sampled = sampled
        self.nth = np.cumsum(sampled) - 1
        self.positions = order[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each pattern (rows of a matrix), read from its last symbol backwards."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.zeros(len(patterns), dtype=np.int64)
        live = np.arange(len(patterns))
        symbol = patterns[:, -1].astype(np.int64)
        a, b = self.less[symbol], self.less[symbol + 1]
        for j in range(patterns.shape[1] - 2, -1, -1):
            some = a < b
            live, a, b = live[some], a[some], b[some]
            symbol = patterns[live, j].astype(np.int64)
            a = self.less[symbol] + self.tree.rank(symbol, a)
            b = self.less[symbol] + self.tree.rank(symbol, b)
        low[live], high[live] = a, b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each row's suffix: steps towards the start of the run until a kept position."""
        rows = rows.copy()
        steps = np.zeros(len(rows), dtype=np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            at = rows[walking]
            symbol = self.last[at].astype(np.int64)
            rows[walking] = self.less[symbol] + self.tree.rank(symbol, at)
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.positions[self.nth[rows]] + steps
