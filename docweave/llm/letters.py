"""Letter words of a batch as flat code-point arrays (used by the learned operators)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .arrays import U64, edges, mix, prefix_hash, span_hash
from .tokens import LETTER, class_table


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    """One-to-one lower-casing of code points."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


class Words:
    """Maximal letter runs, lower-cased, of the rows of a chunk."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
        borders = np.searchsorted(np.flatnonzero((raw & 0xC0) != 0x80), offsets)
        self.points = lower_table()[points]
        self.start, self.end = edges(class_table()[points] == LETTER, borders)
        self.first = np.searchsorted(self.start, borders)  # first word of each row, and the end
        self.prefix = prefix_hash(self.points)
        self.hashes = self.hash(self.start, self.end)

    def hash(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        return mix(span_hash(self.prefix, start, end) + (end - start).astype(U64) + U64(salt << 32))

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class Table:
    """Sorted 64-bit keys with a bit filter in front; finds the few members of a long array fast."""

    BITS = 21

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.filter = np.zeros(1 << self.BITS, dtype=bool)
        self.filter[(keys >> U64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``values``, their index in the original keys) of the members."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.filter[(values >> U64(64 - self.BITS)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        hit = self.keys[slot] == values[at]
        return at[hit], self.order[slot[hit]]
