"""Operator 9, hierarchical multi-length packing.

Each task packs its own documents, block by block (about a million tokens), so
nothing is shuffled and memory is bounded by the block and the longest text.
A document first gives its full windows; its remainder is routed to the tier of
the smallest context size that holds it (1024, 512, 256, 128 by default).  Tiers
are packed from long to short: every window opens with a remainder of its own
tier, its gap is filled with the longest shorter-tier remainders that fit,
and what is left of the gap with the head of one that does not.  Windows thus end
full at their own context size.  Only a block's last window can stay short; it is
cut into power-of-two lengths, so it needs no padding either.  Finally windows of
each length are dealt in turn to the step groups of the block, which gives all
groups of a block the same mix of lengths (tokens and attention cost).

Defined results: null and empty texts are one piece, the closing id alone; null ids pass
through; repeated rows are packed as documents of their own; an empty table gives
an empty result.  Sequence and step numbers come from the partition number, so a
task that is run again after a lost executor writes the same numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .arrays import chunks, text_arrays
from .tokens import CHUNK, merges_of, row_tokens, tokenizer_path
from .work import id_and_text

WINDOW = 1024
TIERS = 4
STEP_TOKENS = 32 * 1024
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, window long, step_id long")


class Pool:
    """Remainders (document, start, length) by length; the longest of at most n in O(1)."""

    def __init__(self) -> None:
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.mask = 0  # bit n: there is a remainder of length n

    def put(self, length: int, doc: int, start: int) -> None:
        self.by_length.setdefault(length, []).append((doc, start))
        self.mask |= 1 << length

    def longest(self, most: int) -> int:
        return (self.mask & ((2 << most) - 1)).bit_length() - 1

    def shortest_over(self, n: int) -> int:
        rest = self.mask >> (n + 1)
        return n + (rest & -rest).bit_length() if rest else 0

    def take(self, length: int) -> tuple[int, int]:
        found = self.by_length[length]
        piece = found.pop()
        if not found:
            self.mask &= ~(1 << length)
        return piece


def pack(lengths: list[int], window: int = WINDOW, tiers: int = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (size, [(document, start, length), ...]); a window's lengths add up to its size.

    ``window`` is a power of two, so every size is one too."""
    windows: list[tuple[int, list[tuple[int, int, int]]]] = []
    pool = Pool()
    for doc, n in enumerate(lengths):
        for start in range(0, n - window + 1, window):
            windows.append((window, [(doc, start, window)]))
        if n % window:
            pool.put(n % window, doc, n - n % window)
    for tier in range(tiers):
        size = window >> tier
        least = size // 2 if tier < tiers - 1 else 0
        while (length := pool.longest(size)) > least:
            doc, start = pool.take(length)
            pieces, gap = [(doc, start, length)], size - length
            while gap and pool.mask:
                if (length := pool.longest(gap)) > 0:
                    pieces.append((*pool.take(length), length))
                    gap -= length
                else:
                    whole = pool.shortest_over(gap)
                    doc, start = pool.take(whole)
                    pieces.append((doc, start, gap))
                    pool.put(whole - gap, doc, start + gap)
                    gap = 0
            if gap:  # the block's last window: power-of-two lengths, longest first
                windows.extend(cut(pieces, size - gap))
            else:
                windows.append((size, pieces))
    return windows


def cut(pieces: list[tuple[int, int, int]], total: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    out, queue = [], pieces[::-1]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        room, mine = size, []
        while room:
            doc, start, length = queue.pop()
            used = min(room, length)
            mine.append((doc, start, used))
            if used < length:
                queue.append((doc, start + used, length - used))
            room -= used
        out.append((size, mine))
    return out


def pack_block(ids: pa.Array, lengths: np.ndarray, tokens: np.ndarray, first: int, first_step: int,
               window: int, tiers: int, step_tokens: int) -> tuple[pa.RecordBatch, int, int]:
    """Rows of one block; numbers of the next sequence and step."""
    begin = np.cumsum(lengths) - lengths
    view = memoryview(tokens.astype("<u4").tobytes())
    windows = sorted(pack(lengths.tolist(), window, tiers), key=lambda w: -w[0])
    steps = max(1, -(-int(lengths.sum()) // step_tokens))
    docs, starts, sizes, crcs, seqs, offsets, widths, groups = ([] for _ in range(8))
    for n, (size, pieces) in enumerate(windows):
        at = 0
        for doc, start, length in pieces:
            p = 4 * (int(begin[doc]) + start)
            docs.append(doc)
            starts.append(start)
            sizes.append(length)
            crcs.append(zlib.crc32(view[p:p + 4 * length]))
            seqs.append(first + n)
            offsets.append(at)
            widths.append(size)
            groups.append(first_step + n % steps)
            at += length
    index = np.array(docs, dtype=np.int64)
    columns = [ids.take(pa.array(index)), starts, sizes, crcs, lengths[index] if len(index) else [], seqs, offsets, widths, groups]
    batch = pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns],
        names=[c.split()[0] for c in SCHEMA.split(", ")])
    return batch, first + len(windows), first_step + steps


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   window: int = WINDOW, tiers: int = TIERS, step_tokens: int = STEP_TOKENS, end_id: int = 0) -> DataFrame:
    """One row per piece: which ids of which document lie where (see SCHEMA)."""
    where = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges_of(where)
        sequence = step = TaskContext.get().partitionId() << 40
        for batch in batches:
            raw, off = text_arrays(batch.column(1))
            for i, j in chunks(off, CHUNK):
                counts, flat = row_tokens(model, raw[off[i]:off[j]], off[i:j + 1] - off[i], with_ids=True)
                closed = np.insert(flat, np.cumsum(counts), end_id)
                rows, sequence, step = pack_block(batch.column(0).slice(i, j - i), counts + 1, closed, sequence, step,
                                                  window, tiers, step_tokens)
                yield rows

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
