"""A compressed full-text index (FM-index) over sequences of integer symbols, searched in batches.

The Burrows-Wheeler transform of the sequences, sorted by their first ``depth`` or more symbols, is kept as a
wavelet matrix: one bit vector per bit of a symbol, packed, with a popcount per 64 bits.  ``rank`` queries
of many symbols and places at once are a few array passes per level, so a backward search extends all
patterns of a batch by one symbol at a time.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


class Bits:
    """A packed bit vector; ``ones(i)`` is the number of ones before i."""

    def __init__(self, bits: np.ndarray):
        size = len(bits) // 64 + 1
        packed = np.zeros(size * 8, dtype=np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[:len(some)] = some
        self.words = packed.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        low = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    def __init__(self, values: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        now = values
        for bit in range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1):
            one = (now >> bit) & 1 == 1
            self.levels.append((bit, Bits(one), int(len(one) - one.sum())))
            now = np.concatenate([now[~one], now[one]])

    def places(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place on the lowest level; the difference of two places is the symbol's number between them."""
        for bit, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbols >> bit) & 1 == 1, zeros + ones, at - ones)
        return at


class FMIndex:
    """Index of the sequences ``symbols[starts[i]:starts[i + 1]]``; ``owner`` is a number per sequence.

    Symbols are positive and below ``alphabet``.  Patterns of at most ``depth`` symbols can be searched;
    suffixes need no order beyond that, so ranks are doubled only until they cover ``depth`` symbols."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, owner: np.ndarray, alphabet: int, depth: int):
        sizes = np.diff(starts)
        n = len(symbols) + len(sizes)  # one closing 0 per sequence
        text = np.zeros(n, dtype=np.int64)
        text[np.arange(len(symbols)) + np.repeat(np.arange(len(sizes)), sizes)] = symbols
        rank, covered = text, 1
        while covered < depth:
            behind = np.zeros(n, dtype=np.int64)
            behind[:-covered] = rank[covered:]
            _, rank = np.unique(rank * (n + alphabet) + behind, return_inverse=True)
            covered *= 2
        order = np.argsort(rank, kind="stable")
        self.owner = np.repeat(owner, sizes + 1)[order]  # document array in place of suffix samples
        self.size = n
        self.matrix = WaveletMatrix(text[order - 1], alphabet)
        smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])[:-1]
        every = np.arange(alphabet)
        self.shift = smaller - self.matrix.places(every, np.zeros(alphabet, dtype=np.int64))

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more symbol in front."""
        shift = self.shift[symbols]
        return self.matrix.places(symbols, lo) + shift, self.matrix.places(symbols, hi) + shift

    def least_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest owner in each interval; intervals are equal or do not meet."""
        begin, at = np.unique(lo, return_index=True)
        owner = np.append(self.owner, np.iinfo(self.owner.dtype).max)
        return np.minimum.reduceat(owner, np.column_stack([begin, hi[at]]).ravel())[::2][np.searchsorted(begin, lo)]

    def statistics(self, symbols: np.ndarray, starts: np.ndarray, own: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of streamed sequences, capped at ``depth``: per place where a pattern of
        that length can end, the length of the longest match that ends there and occurs elsewhere
        too, and for full matches the smallest owner of one (else ``own``)."""
        sizes = np.diff(starts)
        first = np.repeat(starts[:-1], sizes)
        length = np.zeros(len(symbols), dtype=np.int64)
        least = np.repeat(own, sizes)
        mine = least.copy()
        at = np.flatnonzero(np.arange(len(symbols)) - first >= depth - 1)  # no full match ends before
        lo, hi = np.zeros(len(at), dtype=np.int64), np.full(len(at), self.size, dtype=np.int64)
        for step in range(depth):
            if not len(at):
                break
            lo, hi = self.extend(symbols[at - step], lo, hi)
            # An interval of one row is the sequence's own place: nothing longer occurs elsewhere.
            shared = hi - lo > 1
            at, lo, hi = at[shared], lo[shared], hi[shared]
            length[at] = step + 1
        full = length[at] == depth if len(at) else np.empty(0, bool)
        at, lo, hi = at[full], lo[full], hi[full]
        if len(at):
            least[at] = np.minimum(self.least_owner(lo, hi), mine[at])
        return length, least
