"""Operator 3, suffix-array dedup with deep-shallow sorting.

Every byte covered by a ``length``-byte string that also starts anywhere else (in this or
another text) is removed.  A suffix matters only by its first ``length`` bytes, and most of
them cannot have a twin, so suffixes are sieved without loss before they are sorted:

1. The anchor of a window (a ``length``-byte string) is the leftmost smallest hash among its
   GRAM-byte substrings.  It depends on the window's content alone, so equal windows have
   equal anchor strings at equal offsets.  One map turns each text into runs of windows
   with the same anchor, about one run per 110 bytes, each with the hashes of the anchor and of the
   run's whole text.
2. An anchor hash that occurs once: none of its windows repeats.  All its runs are equal: all
   repeat.  A run whose text occurs twice repeats as a whole.  Only runs that are the
   only one of their text and share an anchor with others remain; of every other text under
   these anchors one representative joins them.
3. Suffix sorting: all windows of those runs, grouped by anchor and dealt over tasks, are
   sorted by a multikey sort on 8-byte symbols to a shallow depth; each remaining group
   (a long common prefix) goes into a blind trie, which reads only branching
   bytes on the way down and compares once with the leaf it reaches.  Suffixes that
   agree in all ``length`` bytes meet in one leaf; these windows repeat.
4. An anchor with more than ``MOST_SUFFIXES`` windows (a line that very many texts share) is split
   first: its runs are cut into blocks of neighbouring windows, dealt by the bytes that all windows
   of a block have in common, and each part is sorted as above.  A part that still has
   more windows (they agree in almost all bytes) is grouped by the windows' whole bytes.
5. The windows' bytes are united per text and cut out.

Defined results: null and empty texts have 0 bytes, texts shorter than ``length`` lose nothing
as their strings are too short; rows that repeat id and text are each other's twins;
null ids are treated like any id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import U64, chunks, mix, prefix_hash, span_hash, text_arrays
from .work import id_and_text, saved

LENGTH = 400
SHALLOW = 32  # bytes sorted by symbols before the tries take over
BATCH = 200_000  # suffixes sorted at a time in a task
MOST_SUFFIXES = 100_000  # windows of one anchor, or part of one, sorted in one task
BLOCKS = 25  # a block of a hot anchor's windows is length / BLOCKS wide
SEGMENT = 500_000  # bytes looked at together; longer texts are read in overlapping segments
PLACE_BITS = 24
ID = ["doc_id", "text_hash"]


def gram_of(length: int) -> int:
    return max(1, length * 8 // 25)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (prefix and suffix minima of blocks)."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=U64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of windows with one anchor: (row, first start, windows, anchor hash, text hash)."""
    gram, n = gram_of(length), len(raw)
    if n < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, U64),) * 2
    prefix = prefix_hash(raw.astype(np.uint16) + np.uint16(1))
    at = np.arange(n - gram + 1)
    grams = mix(span_hash(prefix, at, at + gram))
    low = U64((1 << PLACE_BITS) - 1)
    anchor = (sliding_min((grams & ~low) | at.astype(U64), length - gram + 1) & low).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + length <= offsets[1:][row])
    anchor, row = anchor[start], row[start]
    if not len(start):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, U64),) * 2
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    begin, windows, anchor = start[first], start[last] - start[first] + 1, anchor[first]
    text = mix(span_hash(prefix, begin, begin + windows + length - 1) + windows.astype(U64))
    return row[first], begin, windows, grams[anchor], mix(text + (anchor - begin).astype(U64))


def segments(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, first byte, end byte) of bounded pieces; a long text gives overlapping pieces."""
    for i, j in chunks(offsets, SEGMENT):
        lo, hi = int(offsets[i]), int(offsets[j])
        for at in range(lo, max(lo + 1, hi - length + 1), SEGMENT) if hi - lo > 2 * SEGMENT else (lo,):
            yield i, j, at, min(hi, at + SEGMENT + length - 1) if hi - lo > 2 * SEGMENT else hi


def run_rows(texts: DataFrame, length: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_arrays(batch.column(2))
            for i, j, lo, hi in segments(off, length):
                row, start, windows, anchor, text = runs(raw[lo:hi], np.clip(off[i:j + 1], lo, hi) - lo, length)
                pick = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pick), batch.column(1).take(pick), pa.array((start + lo - off[row + i]).astype(np.int32)),
                     pa.array(windows.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(text.view(np.int64))],
                    names=[*ID, "start", "windows", "anchor", "run"])

    return texts.select(*ID, "text").mapInArrow(
        find, "doc_id long, text_hash long, start int, windows int, anchor long, run long")


def blind_trie(codes: list[bytes], width: int) -> list[list[int]]:
    """Groups (indices) of equal strings.  A node is (depth, {byte: child}), a leaf its list of indices.

    The search reads only the bytes at the nodes' depths; one comparison with the leaf
    it ends in gives the common prefix and so the place to branch."""
    root: object = [0]
    leaves = [root]
    for i in range(1, len(codes)):
        code, node = codes[i], root
        while isinstance(node, tuple):
            children = node[1]
            node = children.get(code[node[0]]) or next(iter(children.values()))
        other = codes[node[0]]
        if other == code:
            node.append(i)
            continue
        differ = int.from_bytes(code) ^ int.from_bytes(other)
        depth = width - (differ.bit_length() + 7) // 8
        leaf = [i]
        leaves.append(leaf)
        above, node = None, root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][code[node[0]]]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][code[depth]] = leaf
            continue
        branch = (depth, {other[depth]: node, code[depth]: leaf})
        if above is None:
            root = branch
        else:
            above[1][code[above[0]]] = branch
    return leaves


def repeated_windows(strings: list[bytes], groups: np.ndarray, length: int) -> list[np.ndarray]:
    """For every string, which of its windows also is a window of another place in its group.

    Deep-shallow sort of all windows: 8-byte symbols down to SHALLOW bytes, blind tries below."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    data = b"".join(strings)
    windows = sizes - length + 1
    base = np.cumsum(sizes) - sizes
    place = np.repeat(base, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    flag = np.zeros(len(data) + 1, dtype=bool)
    padded = np.zeros(len(data) + 8, dtype=np.uint64)
    padded[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    symbol = np.zeros(len(data) + 1, dtype=np.uint64)
    for j in range(8):
        symbol = (symbol << U64(8)) | padded[j:j + len(symbol)]
    group = np.repeat(groups, windows)
    shallow = min(SHALLOW, length // 8 * 8)
    for depth in range(0, shallow, 8):
        word = symbol[place + depth]
        order = np.lexsort((word, group))
        place, group, word = place[order], group[order], word[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (word[1:] != word[:-1])])
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        place = place[~alone]
        if not len(place):
            break
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(place) else np.empty(0, np.int64)
    where = place.tolist()
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(where)]):
        codes = [data[p + shallow:p + length] for p in where[lo:hi]]
        for leaf in blind_trie(codes, length - shallow):
            if len(leaf) > 1:
                for i in leaf:
                    flag[where[lo + i]] = True
    return [flag[b:b + w] for b, w in zip(base.tolist(), windows.tolist())]


def spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, count) of the runs of True."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    begin = np.flatnonzero(edge == 1)
    return list(zip(begin.tolist(), (np.flatnonzero(edge == -1) - begin).tolist()))


def sort_runs(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated windows (id, start, windows) of the single runs; an anchor's pieces lie in one task, in order."""

    def work(rows: list[tuple]) -> pa.RecordBatch:
        group = np.unique(np.array([r[0] for r in rows], dtype=np.int64), return_inverse=True)[1]
        out = []
        for row, flags in zip(rows, repeated_windows([r[5] for r in rows], group, length)):
            if row[1]:
                out += [(row[2], row[3], row[4] + s, n) for s, n in spans(flags)]
        columns = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()),
             pa.array(columns[3], pa.int32())], names=[*ID, "start", "windows"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        total, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if total >= BATCH and row[0] != last:
                    yield work(held)
                    held, total = [], 0
                held.append(row)
                total += len(row[5]) - length + 1
                last = row[0]
        if held:
            yield work(held)

    return (pieces.select("anchor", "single", *ID, "start", "bytes").repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(sort, "doc_id long, text_hash long, start int, windows int"))


def listed(keys: DataFrame) -> DataFrame:
    """Keys to join with the rows they were counted from.  Written first: joined in the stage that counts
    them, they would bind the join to one task per key, and Spark could not split a hot one."""
    return saved(keys).hint("merge")


def anchor_place(raw: np.ndarray, length: int) -> tuple[int, int]:
    """Offset of the anchor in a run's first window, and the anchor's hash."""
    gram = gram_of(length)
    at = np.arange(length - gram + 1)
    grams = mix(span_hash(prefix_hash(raw[:length].astype(np.uint16) + np.uint16(1)), at, at + gram))
    place = int(np.argmin(grams & ~U64((1 << PLACE_BITS) - 1)))
    return place, int(grams[place])


def split_runs(pieces: DataFrame, length: int) -> DataFrame:
    """Cuts the runs of hot anchors into blocks of neighbouring windows, keyed by content.

    Equal windows hold their anchor at the same offset, so a block is the windows of a run whose anchor
    offsets share their quotient by the block's width.  All windows a block can have contain its core
    (``length - width + 1`` bytes), so equal windows have equal keys (anchor, quotient, core's hash);
    a clash of keys only puts more windows into one sort."""
    width = max(1, length // BLOCKS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for single, doc_id, text_hash, start, data in zip(*(c.to_pylist() for c in batch.columns)):
                raw = np.frombuffer(data, dtype=np.uint8)
                anchor, gram = anchor_place(raw, length)
                prefix, last = prefix_hash(raw.astype(np.uint16) + np.uint16(1)), len(raw) - length
                block = np.arange(max(0, anchor - last) // width, anchor // width + 1)
                first = np.maximum(anchor - (block * width + width - 1), 0)
                end = np.minimum(anchor - block * width, last)
                core = anchor - block * width
                key = mix(span_hash(prefix, core, core + length - width + 1)
                          + mix(U64(gram) + mix(block.astype(U64) + U64(1)))).view(np.int64)
                for k, lo, hi in zip(key.tolist(), first.tolist(), end.tolist()):
                    for column, value in zip(out, (k, single, doc_id, text_hash, start + lo, data[lo:hi + length])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()),
                 pa.array(out[4], pa.int32()), pa.array(out[5], pa.binary())], names=["anchor", "single", *ID, "start", "bytes"])

    return pieces.select("single", *ID, "start", "bytes").mapInArrow(
        cut, "anchor long, single boolean, doc_id long, text_hash long, start int, bytes binary")


def equal_windows(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated windows of blocks whose core very many runs share: the windows are grouped by all their
    bytes, with partial aggregation."""
    rows = saved(pieces.select("single", *ID, "start", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.octet_length("bytes") - length), lambda i: F.substring(F.col("bytes"), i + 1, length))).alias("at", "window")))
    twins = rows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    return (rows.filter("single").join(listed(twins), "window", "left_semi")
            .select(*ID, (F.col("start") + F.col("at")).alias("start"), F.lit(1).alias("windows")))


def sort_hot(pieces: DataFrame, length: int, most_suffixes: int) -> DataFrame:
    """``sort_runs`` for anchors with very many windows: split by content, each part sorted."""
    blocks = saved(split_runs(pieces, length))
    sizes = (blocks.groupBy("anchor").agg(F.sum((F.octet_length("bytes") - length + 1).cast("long")).alias("suffixes"))
             .filter("suffixes > 1").select("anchor", (F.col("suffixes") > most_suffixes).alias("wide")))
    parts = saved(blocks.join(listed(sizes), "anchor"))
    return sort_runs(parts.filter("NOT wide"), length).unionAll(equal_windows(parts.filter("wide"), length))


def same_text(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.text_hash") == F.col(f"{right}.text_hash"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   keep_text: bool = False, most_suffixes: int = MOST_SUFFIXES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with ``keep_text`` also
    the remaining bytes (``kept``) and the removed ``spans`` (start, length)."""
    texts = id_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    # 1, 2. Runs, and what their hashes already decide.
    found = saved(run_rows(texts, length))
    shared = (found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("run").alias("lo"), F.max("run").alias("hi"))
              .filter("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")))
    shared_runs = saved(found.join(listed(shared), "anchor"))
    mixed = shared_runs.filter("mixed")
    runs_of = saved(mixed.groupBy("anchor", "run").agg(
        F.count("*").alias("n"), F.first(F.struct(*ID, "start", "windows")).alias("one")))
    weights = runs_of.groupBy("anchor").agg(F.sum(F.col("one.windows").cast("long")).alias("suffixes"), F.min("n").alias("least"))
    pieces = (runs_of.join(listed(weights.filter("least = 1")), "anchor")
              .select("one.*", "anchor", (F.col("n") == 1).alias("single"), (F.col("suffixes") > most_suffixes).alias("hot")))
    known = (shared_runs.filter("NOT mixed").select(*ID, "start", "windows")
             .unionAll(mixed.join(runs_of.filter("n > 1").select("anchor", "run"), ["anchor", "run"], "left_semi")
                       .select(*ID, "start", "windows")))
    # One pass over the texts: those that lose bytes or hold a piece.
    wanted = (known.withColumn("anchor", F.lit(None).cast("long")).withColumn("single", F.lit(False)).withColumn("hot", F.lit(False))
              .unionByName(pieces)
              .groupBy(*ID).agg(F.collect_list(F.struct("start", "windows", "anchor", "single", "hot")).alias("parts")))
    held = saved(texts.alias("t").join(wanted.alias("w"), same_text("t", "w"))
                 .select("t.doc_id", "t.text_hash", "t.text", "w.parts").dropDuplicates(ID))
    part = held.select(*ID, "text", F.explode(F.filter("parts", lambda p: p["anchor"].isNotNull())).alias("p")).select(
        *ID, "p.*", F.substring(F.col("text").cast("binary"), F.col("p.start") + 1, F.col("p.windows") + length - 1).alias("bytes"))
    part = saved(part)
    # 3, 4. Sort what is left.
    more = sort_runs(part.filter("NOT hot"), length).unionAll(sort_hot(part.filter("hot"), length, most_suffixes))
    extra = more.groupBy(*ID).agg(F.collect_list(F.struct("start", "windows")).alias("more"))
    # 5. Cut.
    lost = F.transform(F.filter("parts", lambda p: p["anchor"].isNull()), lambda p: F.struct(p["start"].alias("start"), p["windows"].alias("windows")))
    cut = (held.alias("t").join(extra.alias("e"), same_text("t", "e"), "left")
           .select("t.doc_id", "t.text_hash", "t.text", F.concat(lost, F.coalesce("e.more", F.array().cast("array<struct<start: int, windows: int>>"))).alias("lost"))
           .mapInArrow(lambda batches: cut_out(batches, length, keep_text), CUT_SCHEMA))
    rows = texts.select("doc_id", "text_hash", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"),
                        *([F.col("text").cast("binary").alias("whole")] if keep_text else []))
    return (rows.alias("r").join(cut.alias("c"), same_text("r", "c"), "left")
            .select("r.doc_id", "r.n_bytes", F.coalesce("c.n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("c.n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("c.sha", "r.sha").alias("kept_sha256"),
                    *([F.coalesce("c.kept", "r.whole").alias("kept"), F.coalesce("c.spans", F.array().cast("array<struct<start: int, length: int>>")).alias("spans")]
                      if keep_text else [])))


CUT_SCHEMA = ("doc_id long, text_hash long, n_removed long, n_spans long, sha string, kept binary, "
              "spans array<struct<start: int, length: int>>")


def cut_out(batches: Iterator[pa.RecordBatch], length: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for text, lost in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            raw = np.frombuffer(text.encode(), dtype=np.uint8)
            depth = np.zeros(len(raw) + 1, dtype=np.int32)
            if lost:
                start = np.array([p["start"] for p in lost])
                np.add.at(depth, start, 1)
                np.add.at(depth, start + np.array([p["windows"] for p in lost]) + length - 1, -1)
            gone = np.cumsum(depth[:-1]) > 0
            kept = raw[~gone].tobytes()
            removed = spans(gone)
            for column, value in zip(out, (int(gone.sum()), len(removed), hashlib.sha256(kept).hexdigest(),
                                           kept if keep_text else None,
                                           [{"start": s, "length": n} for s, n in removed] if keep_text else None)):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
             pa.array(out[3], pa.binary()), pa.array(out[4], kind)], names=[c.split()[0] for c in CUT_SCHEMA.split(", ")[:6]] + ["spans"])


def op3_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
