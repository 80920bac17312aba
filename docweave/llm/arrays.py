"""Flat numpy views of text columns: bytes, words, shingles and their hashes.

Helpers for the operators that run inside ``mapInArrow``: a batch of texts is
held as one byte (or code point) array plus row offsets, so every step is a
handful of whole-array passes instead of a Python loop over words.  Batches
are cut into chunks of bounded size; one row is never split, so memory is
bounded by ``max(chunk, longest text)``.

Words and pre-tokens are identified by 64-bit hashes that read eight bytes per
round (``span_digests``).  Overlapping substrings of bounded length (n-grams, runs
of a few hundred bytes) use polynomial hashes with a fixed odd base: prefix sums give
any substring's hash in O(1).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}

#: Rows per Arrow batch are bounded here as well as by bytes: 2 MB of text at a time.
CHUNK_BYTES = 2_000_000


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (grown on demand, kept per process)."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = np.full(size, base, dtype=U64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (bijective)."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    return h ^ (h >> U64(32))


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the row offsets (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = filled.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[filled.offset:filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each (a longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums for substring hashes; ``values`` must be positive integers."""
    out = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values.astype(U64) * powers(BASE_INVERSE, len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] (not mixed): equal contents give equal hashes."""
    return (prefix[end] - prefix[start]) * powers(BASE, len(prefix))[start]


LONG_SPAN = 4096
#: Masks that keep the first 0 to 8 bytes of a little-endian word.
HEAD_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)


def span_digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings data[start:end], eight bytes of all strings per round.

    A round is a bijection of the state that is not linear in it, so regular strings (repetitive words
    that defeat polynomial hashes) do not meet more often than random ones.  Very long strings are
    digested one by one."""
    size = end - start
    long = size > LONG_SPAN
    order = np.argsort(-np.where(long, 0, size), kind="stable")  # strings still being read come first
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    begin, left = start[order], np.where(long, 0, size)[order]
    state = size[order].astype(U64) * U64(0x9E3779B97F4A7C15) + U64(0x243F6A8885A308D3)
    active = len(order)
    while True:
        active = int(np.searchsorted(-left[:active], 0, side="left"))
        if not active:
            break
        now = state[:active] ^ (words[begin[:active]] & HEAD_MASKS[np.minimum(left[:active], 8)])
        state[:active] = mix(now) + U64(0x13198A2E03707344)
        begin[:active] += 8
        left[:active] -= 8
    out = np.empty(len(order), dtype=U64)
    out[order] = state
    for i in np.flatnonzero(long):
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


ASCII_SPACE = np.zeros(256, dtype=bool)
ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; runs never cross a row border."""
    n = len(inside)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed hashes of the words ``[^ \\t-\\r]+`` (A-Z lower-cased) and, per row,
    the index of its first word (length rows + 1)."""
    low = ASCII_LOWER[raw]
    start, end = edges(~ASCII_SPACE[low], offsets)
    return span_digests(low, start, end), np.searchsorted(start, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles in text order and each row's first index.

    A row with fewer than k words gives one shingle, its whole sequence; a row
    without words gives none."""
    n = len(words)
    mult = powers(0xC2B2AE3D27D4EB4F, k + 1)
    padded = np.zeros(n + k, dtype=U64)
    padded[:n] = words
    counts = np.diff(first)
    full = np.zeros(n, dtype=U64)
    for j in range(k):
        full += padded[j:j + n] * mult[j]
    full = mix(full + U64(k))
    keep = np.zeros(n, dtype=bool)
    long_rows = counts >= k
    if n:
        delta = np.zeros(n + 1, dtype=np.int64)
        np.add.at(delta, first[:-1][long_rows], 1)
        np.add.at(delta, (first[1:] - k + 1)[long_rows], -1)
        keep = np.cumsum(delta[:-1]) > 0
    for length in range(1, k):
        at = first[:-1][counts == length]
        if len(at):
            h = np.zeros(len(at), dtype=U64)
            for j in range(length):
                h += words[at + j] * mult[j]
            full[at] = mix(h + U64(length))
            keep[at] = True
    sizes = np.where(long_rows, counts - k + 1, (counts > 0).astype(np.int64))
    return full[keep], np.concatenate([[0], np.cumsum(sizes)])


def distinct_rows(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the sorted distinct values."""
    parts, sizes = [], np.zeros(len(first), dtype=np.int64)
    for i in range(len(first) - 1):
        if first[i + 1] > first[i]:
            seg = np.sort(values[first[i]:first[i + 1]])
            if len(seg) > 1:
                seg = seg[np.concatenate([[True], seg[1:] != seg[:-1]])]
            parts.append(seg)
            sizes[i + 1] = len(seg)
    return (np.concatenate(parts) if parts else np.empty(0, U64)), np.cumsum(sizes)
