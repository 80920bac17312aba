"""Byte-level BPE over whole batches as ragged numpy arrays, and operator 7.

``pretokens`` splits a batch of texts at once: code points are mapped to four
classes (letter, number, space, other) and the splitting rule of byte-level
BPE (contractions, an optional leading blank, the last blank of a run goes to the
next token) becomes a few mask operations on run borders.  Each distinct
pre-token of a chunk is then merged once, rank-synchronously: all of them sit
in one flat symbol array, every round finds each sequence's lowest-rank pair
and applies it in all sequences simultaneously, and finished sequences leave the
array.  Equal ranks in one sequence merge left to right, as the sequential
rule does (a pair made by a merge always has a higher rank than that merge).
Pre-tokens are told apart by 64-bit hashes (``arrays.span_digests``, not linear in the bytes) among the at most
half a million a task remembers and those of one chunk: a clash has a chance below 1e-7.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import U64, chunks, span_digests, text_arrays
from .work import id_and_text

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
TOKEN_LIMIT = 1024
CHUNK = 3_000_000
NO_RANK = np.int32(2**31 - 1)
#: Unicode White_Space, and the contractions of the splitting rule.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)),
                        dtype=np.uint8, count=0x110000)
    table[WHITE_SPACE] = SPACE
    return table


def pretokens(points: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Start index of every pre-token; ``borders`` (row starts and the end) are never crossed."""
    n = len(points)
    if n == 0:
        return np.empty(0, np.int64)
    kind = class_table()[points]
    first = np.zeros(n + 1, dtype=bool)
    first[borders] = True
    run = np.empty(n, dtype=bool)
    run[0] = True
    run[1:] = (kind[1:] != kind[:-1]) | first[1:n]
    start = run.copy()
    inner = run[1:] & ~first[1:n]  # run borders inside a row, as index of the later run minus 1
    after_space = np.flatnonzero(inner & (kind[:-1] == SPACE))  # last blank before a non-blank run
    start[after_space] = True
    glued = after_space[points[after_space] == 0x20]
    start[glued + 1] = False
    quote = np.flatnonzero((points == 0x27) & run)
    if len(quote):
        ok = first[quote] | (points[np.maximum(quote - 1, 0)] != 0x20)
        quote = quote[ok]
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        fenced = np.concatenate([first, np.ones(3, dtype=bool)])
        done = np.zeros(len(quote), dtype=bool)
        for tail in CONTRACTIONS:
            hit = ~done
            for j, ch in enumerate(tail, 1):
                hit &= (padded[quote + j] == ord(ch)) & ~fenced[np.minimum(quote + j, n)]
            at = quote[hit]
            done |= hit
            start[at + 1] = False
            end = at + 1 + len(tail)
            end = end[end < n]
            start[end] |= True  # the rest of the letters is a pre-token of its own
            after = end[(kind[end] != SPACE) & ~first[end] & (points[end - 1] == 0x20)]
            start[after] = False
    return np.flatnonzero(start)


class Merges:
    """Merge table of a byte-level BPE file: pair -> (rank, id), as an open-addressing hash table."""

    BITS = 19

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        # The printable stand-ins of bytes: printable Latin-1 stands for itself, the rest from 256 up.
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.known = Known()
        self.byte_ids = np.array([vocab[letter[b]] for b in range(256)], dtype=np.uint32)
        size = 1 << self.BITS
        self.keys = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
        self.ranks = np.full(size, NO_RANK, dtype=np.int32)
        self.ids = np.zeros(size, dtype=np.uint32)
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            key = (vocab[a] << 16) | vocab[b]
            slot = ((key * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - self.BITS)
            while self.keys[slot] != 0xFFFFFFFF:
                slot = (slot + 1) % size
            self.keys[slot], self.ranks[slot], self.ids[slot] = key, rank, vocab[a + b]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each pair; a slot whose key differs means: no such merge."""
        slot = ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.BITS)).astype(np.int64)
        found = self.keys[slot]
        open_ = np.flatnonzero((found != keys) & (found != 0xFFFFFFFF))
        while len(open_):
            slot[open_] = (slot[open_] + 1) % (1 << self.BITS)
            found = self.keys[slot[open_]]
            open_ = open_[(found != keys[open_]) & (found != 0xFFFFFFFF)]
        return slot

    def merge(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the byte sequences data[start:end], flat, and their offsets."""
        sizes = end - start
        owner = np.repeat(np.arange(len(start), dtype=np.int32), sizes)
        firsts = np.cumsum(sizes) - sizes
        sym = self.byte_ids[data[np.arange(len(owner)) + np.repeat(start - firsts, sizes)]]
        final: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(sym), NO_RANK, dtype=np.int32)  # of the pair (symbol, right neighbour)
        made = np.zeros(len(sym), dtype=np.uint32)  # the id that pair would become
        stale = np.arange(len(sym))  # pairs to look up: all at first, then only those beside a merge
        while len(sym):
            last = np.empty(len(sym), dtype=bool)
            last[-1] = True
            np.not_equal(owner[1:], owner[:-1], out=last[:-1])
            rank[stale] = NO_RANK
            stale = stale[~last[stale]]
            keys = (sym[stale] << np.uint32(16)) | sym[stale + 1]
            slot = self.slots(keys)
            hit = self.keys[slot] == keys
            rank[stale[hit]] = self.ranks[slot[hit]]
            made[stale[hit]] = self.ids[slot[hit]]
            begins = np.concatenate([[0], np.flatnonzero(last[:-1]) + 1])
            lengths = np.diff(np.append(begins, len(sym)))
            lowest = np.repeat(np.minimum.reduceat(rank, begins), lengths)
            keep = lowest != NO_RANK  # sequences that still merge
            if not keep.all():
                final.append((owner[~keep], sym[~keep]))
            # Each sequence's lowest-rank pair; of overlapping ones every second.
            pos = np.flatnonzero((rank == lowest) & keep)
            if len(pos):
                heads = np.concatenate([[True], (pos[1:] != pos[:-1] + 1) | last[pos[:-1]]])
                if not heads.all():
                    at = np.arange(len(pos))
                    pos = pos[(at - np.maximum.accumulate(np.where(heads, at, 0))) % 2 == 0]
                sym[pos] = made[pos]
                rank[pos] = -1  # marks both neighbours' pairs as stale below
                keep[pos + 1] = False
            sym, owner, rank, made = sym[keep], owner[keep], rank[keep], made[keep]
            merged = np.flatnonzero(rank == -1)
            stale = np.union1d(merged, np.maximum(merged - 1, 0))
        if not final:
            return np.empty(0, np.uint32), np.zeros(len(start) + 1, np.int64)
        owners = np.concatenate([f[0] for f in final])
        ids = np.concatenate([f[1] for f in final])
        order = np.argsort(owners, kind="stable")
        return ids[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(start)))])


class Known:
    """Pre-tokens merged so far in this process: hash -> slot, slot -> ids.  Cleared when large."""

    LIMIT = 500_000

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.hashes, self.slots = np.empty(0, U64), np.empty(0, np.int64)
        self.ids, self.offsets = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.slots[at], self.hashes[at] == hashes

    def add(self, hashes: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> None:
        """``hashes`` sorted and new."""
        slots = len(self.offsets) - 1 + np.arange(len(hashes))
        both = np.concatenate([self.hashes, hashes])
        order = np.argsort(both, kind="stable")  # two sorted runs
        self.hashes, self.slots = both[order], np.concatenate([self.slots, slots])[order]
        self.offsets = np.concatenate([self.offsets, offsets[1:] + self.offsets[-1]])
        self.ids = np.concatenate([self.ids, ids])


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(path)


def row_tokens(model: Merges, raw: np.ndarray, offsets: np.ndarray, with_ids: bool):
    """Token count per row; with ids also the flat ids of all rows in order."""
    rows = len(offsets) - 1
    text = raw.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    leads = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each code point
    borders = np.searchsorted(leads, offsets)
    byte_at = np.append(leads, len(raw))
    special: list[tuple[int, int, int]] = []
    for mark, mark_id in model.special.items():
        p = text.find(mark)
        while p >= 0:
            row_end = borders[np.searchsorted(borders, p, side="right")]
            if p + len(mark) <= row_end:
                special.append((p, p + len(mark), mark_id))
                p = text.find(mark, p + len(mark))
            else:
                p = text.find(mark, p + 1)
    cuts = np.concatenate([borders, *[np.array(s[:2]) for s in special]]) if special else borders
    start = pretokens(points, cuts)
    end = np.append(start[1:], len(points))[:len(start)]
    hashes = span_digests(raw, byte_at[start], byte_at[end])
    if special:  # one token per mark; its inner pre-tokens go
        drop = np.zeros(len(start), dtype=bool)
        fixed = {}
        for p, q, mark_id in special:
            i, j = np.searchsorted(start, [p, q])
            drop[i + 1:j] = True
            fixed[int(i)] = (q, mark_id)
        marks = np.array(sorted(fixed))
        end[marks] = [fixed[int(i)][0] for i in marks]
        hashes[marks] = [U64(fixed[int(i)][1]) for i in marks]
        is_mark = np.zeros(len(start), dtype=bool)
        is_mark[marks] = True
        start, end, hashes, is_mark = start[~drop], end[~drop], hashes[~drop], is_mark[~drop]
    different, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    if len(model.known.hashes) > Known.LIMIT:
        model.known.clear()
    slot, seen = model.known.find(different)
    new = sample[~seen]
    ids, offsets = model.merge(raw, byte_at[start[new]], byte_at[end[new]])
    if special and is_mark[new].any():
        sizes = np.diff(offsets)
        begin = offsets[:-1][is_mark[new]]
        ids[begin] = hashes[new][is_mark[new]].astype(np.uint32)
        keep = np.ones(len(ids), dtype=bool)
        for b, size in zip(begin, sizes[is_mark[new]]):
            keep[b + 1:b + size] = False
        ids, offsets = ids[keep], np.concatenate([[0], np.cumsum(np.where(is_mark[new], 1, sizes))])
    model.known.add(different[~seen], ids, offsets)
    slot[~seen] = len(model.known.offsets) - 1 - len(new) + np.arange(len(new))
    slot = slot[inverse]
    first_id = model.known.offsets[slot]
    counts = model.known.offsets[slot + 1] - first_id
    total = np.concatenate([[0], np.cumsum(counts)])
    row_first = total[np.searchsorted(start, borders)]
    if not with_ids:
        return np.diff(row_first), None
    flat = np.arange(total[-1]) + np.repeat(first_id - total[:-1], counts)
    return np.diff(row_first), model.known.ids[flat]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row.

    ``path`` is a byte-level BPE tokenizer file that every executor can read.
    Null and empty texts have 0 tokens; repeated rows each give a row; null ids
    pass through; whole texts of any length are counted (a text is never split,
    so a task needs memory for its longest text)."""
    where = path or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges_of(where)
        for batch in batches:
            raw, off = text_arrays(batch.column(1))
            for i, j in chunks(off, CHUNK):
                n, _ = row_tokens(model, raw[off[i]:off[j]], off[i:j + 1] - off[i], with_ids=False)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(off[i:j + 1])), pa.array(n.astype(np.int64)),
                     pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
