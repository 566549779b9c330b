"""FM-index over a sequence of word numbers, searched for many phrases at once."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling. Zeros separate runs and differ from one
    another (by place), so no comparison goes past a run's end."""
    n = len(text)
    zeros = text == 0
    separators = int(zeros.sum())
    rank = text.astype(np.int64) + separators
    rank[zeros] = np.arange(separators)
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        following = np.full(n, -1, np.int64)
        following[: n - width] = rank[width:]
        order = np.lexsort((following, rank)) if width == 1 else order[np.lexsort((following[order], rank[order]))]
        changed = (np.diff(rank[order]) != 0) | (np.diff(following[order]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = np.r_[0, np.cumsum(changed)]
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        width *= 2


class WaveletTree:
    """Ranks of a sequence's symbols, one level of bits per bit of the alphabet."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        at, start = places.astype(np.int64), np.zeros(len(places), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbols >> (self.bits - 1 - level)) & 1
            high_at, high_start = ones[at], ones[start]
            at = np.where(bit == 1, zeros + high_at, at - high_at)
            start = np.where(bit == 1, zeros + high_start, start - high_start)
        return at - start


class FmIndex:
    """Word numbers from 1, runs separated (and ended) by 0."""

    def __init__(self, text: np.ndarray, alphabet: int, sample: int = 8):
        order = suffix_array(text)
        before = np.where(order > 0, text[order - 1], 0)
        self.last = before
        self.tree = WaveletTree(before, max(1, int(alphabet).bit_length()))
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=alphabet + 1))]
        # Starts of runs are sampled too, so no walk has to cross a separator.
        self.sampled = (order % sample == 0) | (before == 0)
        self.places = order[self.sampled]
        self.sampled_before = np.cumsum(self.sampled) - self.sampled

    def _step(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.first[symbols] + self.tree.rank(symbols, rows)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of suffixes that begin with each phrase (a row of numbers)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbols = phrases[live, column]
            low[live] = self._step(symbols, low[live])
            high[live] = self._step(symbols, high[live])
            live = live[low[live] < high[live]]
        high = np.maximum(low, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffix rows."""
        result = np.zeros(len(rows), np.int64)
        waiting, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(waiting):
            known = self.sampled[at]
            result[waiting[known]] = self.places[self.sampled_before[at[known]]] + steps
            waiting, at = waiting[~known], at[~known]
            at = self._step(self.last[at], at)
            steps += 1
        return result
