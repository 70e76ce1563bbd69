"""FM-index over sequences of word ids: wavelet-matrix rank, backward search, smallest owner of a match."""

from __future__ import annotations

import numpy as np


class RankBits:
    """A bit vector packed into 64-bit words with counts before each word: ``rank(i)`` ones in ``[0, i)``."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class FMIndex:
    """Index of ``text`` (ids from 1; 0 ends each sequence) whose positions belong to ``owner``."""

    def __init__(self, text: np.ndarray, owner: np.ndarray):
        self.n = len(text)
        order = suffix_array(text)
        bwt = text[order - 1]
        self.sigma = int(text.max()) + 1 if self.n else 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        self.levels, values = [], bwt.copy()
        for bit in range(max(1, int(self.sigma - 1).bit_length()) - 1, -1, -1):
            bits = (values >> bit & 1).astype(np.uint8)
            self.levels.append((bit, RankBits(bits)))
            values = np.concatenate([values[bits == 0], values[bits == 1]])
        # where the occurrences of each symbol start, less where the levels lead the start of the transform
        every = np.arange(self.sigma)
        self.base = self.first[every] - self._down(every, np.zeros(self.sigma, np.int64))[0]
        # smallest owner over 2^k consecutive suffixes
        self.low = [owner[order]]
        while 2 ** len(self.low) <= self.n:
            half, last = 2 ** (len(self.low) - 1), self.low[-1]
            self.low.append(np.minimum(last[:-half], last[half:]))

    def _down(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """Places in the transform, followed through the levels of the matrix along the bits of each symbol."""
        at = list(places)
        for bit, bits in self.levels:
            one = (symbol >> bit & 1).astype(bool)
            zeros = self.n - bits.ones
            for k, p in enumerate(at):
                r = bits.rank(p)
                at[k] = np.where(one, zeros + r, p - r)
        return at

    def search(self, symbols: np.ndarray, until_alone: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of the rows of ``symbols`` (patterns of one length), by backward search.

        With ``until_alone``, for patterns that the text holds, a pattern is not extended once what has been read of
        it has one occurrence: the interval is then that of the part, which is in the same sequence.
        """
        lo, hi = np.zeros(len(symbols), np.int64), np.full(len(symbols), self.n, np.int64)
        active = np.arange(len(symbols))
        for column in symbols.T[::-1]:
            if until_alone:
                active = active[hi[active] - lo[active] > 1]
            c = column[active]
            a, b = self._down(c, lo[active], hi[active])
            lo[active], hi[active] = self.base[c] + a, self.base[c] + b
        return lo, hi

    def smallest_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest owner within each non-empty interval."""
        level = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(lo), self.low[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.low[k][lo[at]], self.low[k][hi[at] - 2**k])
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the rotations of ``text`` by prefix doubling; equal rotations keep any order."""
    n = len(text)
    rank, size = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while n > 1 and size < n:
        key = rank * n + np.roll(rank, -size)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if fresh[order[-1]] == n - 1:
            break
        rank, size = fresh, size * 2
    return order
