"""Operator 13, fill-in-middle transformation.

A text is read as units (a run of ASCII letters, or any other single code point).  Two
cuts, drawn from a hash of the document's id, split it into prefix, middle and suffix, which
are written in one of two orders with sentinels, or left plain.

A cut is a number of units, so it has to be turned into a place in the text.  Texts are
divided into blocks of ``BLOCK`` bytes; a block's number of unit starts and of code
points are kept in a Fenwick tree per text (two counts per node).  A binary-lifting descent
walks down the tree's powers of two to the block that holds the unit, adding up the code points it
passes, and the boundary is then located among the unit starts of that one block.
The counts of all blocks of a batch are taken in one pass over its bytes.

Defined results: null and empty texts have no unit and stay plain; a text that holds a sentinel
stays plain, so every output can be read back; a null id is hashed as an empty one;
repeated rows are transformed alike; texts of any length are cut whole (a task needs memory for its
longest text); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import CHUNK_BYTES, chunks, text_arrays
from .work import id_and_text

BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
CUT_PERCENT, SPM_PERCENT = 90, 20
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
IS_LETTER = np.zeros(256, dtype=bool)
IS_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Fenwick:
    """Unit and code-point counts over a text's blocks; node i (from 1) sums the blocks i - lowbit(i) to i - 1."""

    def __init__(self, units: np.ndarray, points: np.ndarray):
        self.size = len(units)
        node = np.arange(1, self.size + 1)
        below = node - (node & -node)
        self.units, self.points = (
            (total[node] - total[below]).tolist() for total in (np.concatenate([[0], np.cumsum(x)]) for x in (units, points)))

    def descend(self, unit: int) -> tuple[int, int, int]:
        """(block that holds unit number ``unit``, units before it in the block, code points before the block).

        For the number behind the last unit the block is the one behind the last block."""
        at, points = 0, 0
        step = 1 << self.size.bit_length() >> 1
        while step:
            if at + step <= self.size and self.units[at + step - 1] <= unit:
                at += step
                unit -= self.units[at - 1]
                points += self.points[at - 1]
            step >>= 1
        return at, unit, points


def marks(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per byte: whether a unit starts here, and whether a code point does."""
    lead = (raw & 0xC0) != 0x80
    letter = IS_LETTER[raw]
    unit = lead.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1])
    firsts = offsets[:-1]
    unit[firsts[firsts < len(raw)]] = True
    return unit, lead


def block_counts(unit: np.ndarray, lead: np.ndarray, offsets: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit and code-point counts of all blocks, and the first block of each row (and the end)."""
    blocks = -(-np.diff(offsets) // block)
    first = np.concatenate([[0], np.cumsum(blocks)])
    if not first[-1]:
        return np.empty(0, np.int64), np.empty(0, np.int64), first
    starts = np.repeat(offsets[:-1] - first[:-1] * block, blocks) + np.arange(first[-1]) * block
    return np.add.reduceat(unit.astype(np.int64), starts), np.add.reduceat(lead.astype(np.int64), starts), first


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))  # type: ignore[return-value]


def transform(ids: list, raw: np.ndarray, offsets: np.ndarray, seed: int = SEED, cut_percent: int = CUT_PERCENT,
              spm_percent: int = SPM_PERCENT, block: int = BLOCK) -> list[tuple]:
    """(units, form, prefix code points, middle code points, output bytes) of every row."""
    unit, lead = marks(raw, offsets)
    units, points, first = block_counts(unit, lead, offsets, block)
    data = raw.tobytes()
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    out = []
    for row, doc_id in enumerate(ids):
        lo, hi = int(offsets[row]), int(offsets[row + 1])
        text = data[lo:hi]
        a, b = int(first[row]), int(first[row + 1])
        n = int(units[a:b].sum())
        h1, h2, h3, h4 = draws(doc_id, seed)
        if not text or h3 % 100 >= cut_percent or p in text or s in text or m in text:
            out.append((n, "plain", None, None, text))
            continue
        tree = Fenwick(units[a:b], points[a:b])
        ends = []
        for cut in sorted((h1 % (n + 1), h2 % (n + 1))):
            at, inside, before = tree.descend(cut)
            begin = lo + at * block
            if begin < hi:  # locate the boundary among the block's unit starts
                place = int(np.flatnonzero(unit[begin:min(begin + block, hi)])[inside])
                ends.append((begin - lo + place, before + int(lead[begin:begin + place].sum())))
            else:
                ends.append((hi - lo, before))
        (x, x_points), (y, y_points) = ends
        prefix, middle, suffix = text[:x], text[x:y], text[y:]
        if h4 % 100 < spm_percent:
            out.append((n, "spm", x_points, y_points - x_points, b"".join((s, suffix, p, prefix, m, middle))))
        else:
            out.append((n, "psm", x_points, y_points - x_points, b"".join((p, prefix, s, suffix, m, middle))))
    return out


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per input row: doc_id, n (units), form, prefix_chars, middle_chars, output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_arrays(batch.column(1))
            for i, j in chunks(off, CHUNK_BYTES):
                ids = batch.column(0).slice(i, j - i)
                rows = transform(ids.to_pylist(), raw[off[i]:off[j]], off[i:j + 1] - off[i], seed, cut_percent, spm_percent)
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary()).view(pa.string())],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of.  Texts hold no sentinel, so each one's first place is its own."""

    def between(left: str, right: str | None) -> Column:
        begin = F.instr(output, left) + len(left)
        return F.substring(output, begin, F.instr(output, right) - begin if right else F.char_length(output))

    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX)))
            .otherwise(output))


def op13_fill_middle(spark, sf_dir: str) -> DataFrame:
    made = fill_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '(?s)[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS g FROM documents),
h AS (SELECT doc_id, x, u, len(u) AS n, CAST('0x' || g[1:8] AS BIGINT) AS h1, CAST('0x' || g[9:16] AS BIGINT) AS h2,
             CAST('0x' || g[17:24] AS BIGINT) AS h3, CAST('0x' || g[25:32] AS BIGINT) AS h4 FROM t),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN x = '' OR contains(x, '{PREFIX}') OR contains(x, '{SUFFIX}') OR contains(x, '{MIDDLE}') OR h3 % 100 >= {CUT_PERCENT}
                  THEN 'plain' WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
              ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM p
"""
