"""An FM-index over a sequence of integer symbols, in numpy: wavelet matrix, backward search, locate.

Symbol 0 separates runs; no pattern holds it and no walk crosses it. All operations take arrays of
patterns or rows, so that thousands of searches advance together.
"""

from __future__ import annotations

import numpy as np

from .common import ship

ship(__name__)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; every 0 counts as a symbol of its own, smaller than the rest."""
    n = len(text)
    gaps = text == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, text.astype(np.int64) + n)
    width = 1
    order = np.argsort(rank, kind="stable")
    while True:
        key = rank[order]
        fresh = np.ones(n, bool)
        fresh[1:] = key[1:] != key[:-1]
        if width > 1:
            second = np.zeros(n, np.int64)
            half = width // 2
            second[: n - half] = old[half:] + 1
            other = second[order]
            first = old[order]
            fresh[1:] = (first[1:] != first[:-1]) | (other[1:] != other[:-1])
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        old = ranks
        follow = np.zeros(n, np.int64)
        follow[: n - width] = old[width:] + 1
        rank = old * (n + 2) + follow
        order = np.argsort(rank, kind="stable")
        width *= 2


class WaveletMatrix:
    """Ranks and accesses over ``symbols`` below ``size``: one bit vector with running counts for each bit."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.bits = max(1, int(size - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        current = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (current >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            current = np.concatenate((current[bit == 0], current[bit == 1]))
        self.begin = self._descend(np.arange(size), np.zeros(size, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbols >> (self.bits - 1 - level)) & 1
            before = ones[at]
            at = np.where(bit == 1, zeros + before, at - before)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        return self._descend(symbols, at) - self.begin[symbols]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it stands before it."""
        symbols = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            before = ones[at]
            bit = ones[at + 1] - before
            symbols = symbols * 2 + bit
            at = np.where(bit == 1, zeros + before, at - before)
        return symbols, at - self.begin[symbols]


class FMIndex:
    """Index of ``text``, whose symbols are below ``size``; every ``rate``-th position is kept for locating."""

    def __init__(self, text: np.ndarray, size: int, rate: int = 8) -> None:
        order = suffix_array(text)
        before = text[order - 1]
        self.tree = WaveletMatrix(before.astype(np.int64), size)
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=size))))
        # a run's first position is always kept, so that a walk ends before it meets a separator
        kept = (order % rate == 0) | (before == 0) | (order == 0)
        self.kept, self.nth, self.positions = kept, np.cumsum(kept) - 1, order[kept]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of the suffixes that start with each row of ``patterns`` (all of one length)."""
        last = patterns[:, -1]
        low, high = self.below[last].copy(), self.below[last + 1].copy()
        for column in range(patterns.shape[1] - 2, -1, -1):
            alive = np.flatnonzero(low < high)
            if not len(alive):
                break
            symbol = patterns[alive, column]
            low[alive] = self.below[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.below[symbol] + self.tree.rank(symbol, high[alive])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the text of each row's suffix: steps back to the next kept position."""
        out = np.zeros(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            done = self.kept[at]
            out[open_[done]] = self.positions[self.nth[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            if len(open_):
                symbol, before = self.tree.access(at)
                at = self.below[symbol] + before
            steps += 1
        return out
