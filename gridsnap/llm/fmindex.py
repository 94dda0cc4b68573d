"""An FM-index over the words of a corpus shard, in arrays: backward search by wavelet-matrix ranks, sampled locate."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of integers from 0; a suffix sorts before its extensions.

    As many symbols as fit a machine word are sorted at once; then prefix doubling goes on with those suffixes alone that still
    tie with another, in ordinary text the few that stand in repeated documents.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bits = int(text.max() + 1).bit_length()
    width = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for k in range(width):
        key <<= bits
        key[: max(0, n - k)] |= text[k:] + 1
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    # at: places in the order whose suffix ties with a neighbour's.
    at = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(at):
        tied = order[at]
        ahead = tied + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        order[at] = tied
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[tied] = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
        at = at[~(new & np.append(new[1:], True))]
        width *= 2
    return order


class WaveletMatrix:
    """Counts of a symbol before a position in O(bits), for whole arrays of questions at once."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ones, self.zeros = [], []
        current = symbols
        for level in reversed(range(self.bits)):
            bit = ((current >> level) & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate((current[~bit], current[bit]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often symbol[i] occurs before at[i]."""
        lo, hi = np.zeros_like(at), at
        for k, level in enumerate(reversed(range(self.bits))):
            ones, bit = self.ones[k], ((symbol >> level) & 1).astype(bool)
            lo1, hi1 = ones[lo], ones[hi]
            lo, hi = np.where(bit, self.zeros[k] + lo1, lo - lo1), np.where(bit, self.zeros[k] + hi1, hi - hi1)
        return hi - lo

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions and how often each occurs before its position."""
        symbol, lo = np.zeros_like(at), np.zeros_like(at)
        for k in range(self.bits):
            ones = self.ones[k]
            bit = ones[at + 1] > ones[at]
            symbol = symbol * 2 + bit
            at = np.where(bit, self.zeros[k] + ones[at], at - ones[at])
            lo = np.where(bit, self.zeros[k] + ones[lo], lo - ones[lo])
        return symbol, at - lo


class FMIndex:
    """Index of a sequence of symbols 1.. (0 is the end mark). step: every step-th text position is sampled for locate."""

    def __init__(self, text: np.ndarray, step: int = 16) -> None:
        text = np.concatenate((text.astype(np.int64), [0]))
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.n, self.sigma = len(text), int(text.max()) + 1
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.sigma))))
        self.tree = WaveletMatrix(bwt, self.sigma)
        sampled = sa % step == 0
        self.is_sampled, self.sample_rank, self.samples = sampled, np.concatenate(([0], np.cumsum(sampled))), sa[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [lo, hi) of patterns, one per row, all of one length; symbols outside the index find nothing."""
        lo, hi = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n, dtype=np.int64)
        for c in patterns.T[::-1]:
            known = (c > 0) & (c < self.sigma)
            s = np.where(known, c, 0)
            lo, hi = self.starts[s] + self.tree.rank(s, lo), self.starts[s] + self.tree.rank(s, hi)
            lo = np.where(known, lo, hi)
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk backwards to the nearest sampled position."""
        at, steps, out = rows.copy(), np.zeros(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.is_sampled[at[todo]]
            done = todo[hit]
            out[done] = self.samples[self.sample_rank[at[done]]] + steps[done]
            todo = todo[~hit]
            if len(todo):
                symbol, before = self.tree.access(at[todo])
                at[todo] = self.starts[symbol] + before
                steps[todo] += 1
        return out
