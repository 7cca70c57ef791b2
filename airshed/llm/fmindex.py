"""An FM-index over sequences of word numbers, in numpy.

The text is a concatenation of runs, each closed by a separator (symbol 0). The
index holds the wavelet matrix of the Burrows-Wheeler transform (a wavelet tree
whose levels are stored as one bit vector with prefix counts each) and the
suffix positions of every ``SAMPLE``-th text position and of each run's first. All
searches are batched: one array operation per level handles all patterns.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffix array by prefix doubling. Each separator counts as a symbol of
    its own, smaller than every word, so comparisons end with the run."""
    n = len(text)
    separators = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(separators)
    rank[separators] = np.arange(len(separators))
    step = 1
    while True:
        following = np.full(n, -1, dtype=np.int64)
        following[:n - step] = rank[step:]
        key = rank * (rank.max() + 2) + following + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """rank(c, i): how often symbol c stands among the first i."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for bit in range(max(1, (n_symbols - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1
            counts = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(ones, out=counts[1:])
            zeros = len(symbols) - int(counts[-1])
            self.levels.append((bit, counts, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(i), i
        for bit, counts, zeros in self.levels:
            one = ((c >> bit) & 1).astype(bool)
            low, high = (np.where(one, zeros + counts[low], low - counts[low]), np.where(one, zeros + counts[high], high - counts[high]))
        return high - low


class FMIndex:
    def __init__(self, text: np.ndarray, n_symbols: int):
        """``text``: word numbers from 1 to n_symbols - 1, runs closed by 0; it ends with 0."""
        order = suffix_order(text)
        last = text[order - 1]  # the position before 0 is the final separator
        self.size, self.last = len(text), last
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])  # symbols smaller than c
        self.tree = WaveletMatrix(last, n_symbols)
        sampled = (order % SAMPLE == 0) | (last == 0)
        self.sampled, self.nth = sampled, np.cumsum(sampled) - 1
        self.position = order[sampled]

    def _step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.before[c] + self.tree.rank(c, i)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns (rows, right-aligned) at once: first and end row of each."""
        first, end = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.size, dtype=np.int64)
        for back in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (first < end))
            if len(live):
                c = patterns[live, -back]
                first[live], end[live] = self._step(c, first[live]), self._step(c, end[live])
        return first, np.maximum(first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffix rows: step back to a sampled one, at most SAMPLE - 1 times."""
        rows, out, steps = rows.copy(), np.empty(len(rows), dtype=np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            known = self.sampled[at]
            out[open_[known]] = self.position[self.nth[at[known]]] + steps
            open_, at = open_[~known], at[~known]
            rows[open_] = self._step(self.last[at], at)
            steps += 1
        return out
