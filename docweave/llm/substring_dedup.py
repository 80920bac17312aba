"""Operator 11, substring dedup by FM-indexes of content shards.

Every word covered by a window of ``words`` consecutive words whose word sequence also starts in
a document with a smaller id is removed.  Equal windows must meet without streaming every document
against every shard, so shards are formed by content:

1. A window's anchor is the leftmost smallest hash among its ``GRAM``-word substrings.  It depends on the
   window's words alone, so equal windows have equal anchors.  One map turns each text into runs
   of windows with one anchor (a run every five or six words).  Very frequent grams (a line that
   everyone repeats) are found first, in a bounded list, and passed over:
   windows beside such a line take a gram of their own surroundings.  A window made only of
   such grams is a run by itself, with its own hash as anchor, dealt in ``SALTS`` slices.
2. Runs are dealt and sorted by anchor.  An anchor of one single run cannot repeat; it goes.  Of equal runs (anchor
   and run hashes, 128 bits) the one of the smallest id stands for all.
3. The words of these runs are cut from their texts and dealt by anchor to shards of about
   ``SHARD_WORDS`` words.  A task builds the shard's FM-index (wavelet matrix of the Burrows-Wheeler transform over the
   words themselves, with the document array in place of suffix samples) and streams the runs through it:
   backward search yields the matching statistics, and every place where they reach ``words``
   gives an interval, whose smallest document is the window's first one.
4. The first documents go back to all runs; windows whose first document is smaller than their own
   are united per text and cut out.

Defined results: a null id comes after all ids, and rows without id or with one id do not remove each other's
words; null and empty texts have no word; texts with fewer words than a window lose nothing;
repeated rows each give a row; an empty table gives an empty result; other columns are ignored.
Rows of one id with different texts are told apart by 24 bits of the text's hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import ASCII_SPACE, CHUNK_BYTES, U64, chunks, edges, mix, prefix_hash, span_digests, span_hash, text_arrays
from .fm_index import FMIndex
from .suffix_dedup import sliding_min, spans
from .work import id_and_text, saved

WORDS = 13
GRAM = 4
SEGMENT = 500_000  # words of a long text that are looked at together
SHARD_WORDS = 200_000
HOT_RUNS = 2000  # a gram that occurs more often is no anchor ...
MOST_HOT = 1_000_000  # ... and at most so many grams can be that hot: beyond, the limit grows with the corpus
SALTS = 32
PLACE_BITS = 24
NO_GRAM = U64((1 << 64) - 1)
LAST = (1 << 63) - 1
MARK_BITS, WINDOW_BITS = 24, 4


def word_borders(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and each row's first word (and the end)."""
    start, end = edges(~ASCII_SPACE[raw], offsets)
    return start, end, np.searchsorted(start, offsets)


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n neighbouring words."""
    size = len(hashes) - n + 1
    out = np.full(max(0, size), U64(n))
    for j in range(n if size > 0 else 0):
        out = mix(out + hashes[j:j + size])
    return out


def runs(hashes: np.ndarray, first: np.ndarray, hot: np.ndarray, words: int, gram: int):
    """Runs of windows with one anchor: (row, first word, windows, anchor, run hash, whether all grams are hot)."""
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, U64),) * 2 + (np.empty(0, bool),)
    if len(hashes) < words:
        return none
    grams = chained(hashes, gram)
    free = grams
    if len(hot):
        at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        free = np.where(hot[at] == grams, NO_GRAM, grams)
    low = U64((1 << PLACE_BITS) - 1)
    place = np.arange(len(grams)).astype(U64)
    least = sliding_min((free & ~low) | place, words - gram + 1)
    row = np.searchsorted(first, np.arange(len(least)), side="right") - 1
    start = np.flatnonzero(np.arange(len(least)) + words <= first[row + 1])
    if not len(start):
        return none
    row, least = row[start], least[start]
    anchor = (least & low).astype(np.int64)
    all_hot = (least | low) == NO_GRAM
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | all_hot[1:] | all_hot[:-1]])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(start)) - 1
    begin, windows, alone = start[head], start[last] - start[head] + 1, all_hot[head]
    prefix = prefix_hash(mix(hashes))
    text = mix(span_hash(prefix, begin, begin + windows + words - 1) + windows.astype(U64))
    key = np.where(alone, mix(text ^ U64(0x452821E638D01377)), grams[anchor[head]])
    return row[head], begin, windows, key, text, alone


def each_segment(raw: np.ndarray, offsets: np.ndarray, hot: np.ndarray, words: int, gram: int) -> Iterator[tuple]:
    """(row, first word in the row, windows, anchor, run, alone) arrays of the rows of a batch."""
    for i, j in chunks(offsets, CHUNK_BYTES):
        part = raw[offsets[i]:offsets[j]]
        start, end, first = word_borders(part, offsets[i:j + 1] - offsets[i])
        hashes = span_digests(part, start, end)
        for at in range(0, max(1, len(hashes) - words + 1), SEGMENT):
            stop = min(len(hashes), at + SEGMENT + words - 1)
            row, begin, *rest = runs(hashes[at:stop], np.clip(first, at, stop) - at, hot, words, gram)
            yield row + i, begin + at - first[row], *rest


def text_mark(text: str = "text") -> Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << MARK_BITS))


def hot_grams(texts: DataFrame, words: int, gram: int, least: int = HOT_RUNS) -> np.ndarray:
    """Sorted hashes of the grams that occur more than ``least`` times (at most about MOST_HOT).

    A gram counts where it occurs at least three times in a part of CHUNK_BYTES; what is missed so
    only makes a shard larger, never a result different."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_arrays(batch.column(0))
            for i, j in chunks(off, CHUNK_BYTES):
                part = raw[off[i]:off[j]]
                start, end, first = word_borders(part, off[i:j + 1] - off[i])
                grams = chained(span_digests(part, start, end), gram)
                row = np.searchsorted(first, np.arange(len(grams)), side="right")
                found, n = np.unique(grams[np.arange(len(grams)) + gram <= first[row]], return_counts=True)
                some = n >= 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(found[some].view(np.int64), 0)), pa.array(np.append(n[some], len(grams))),
                     pa.array(np.arange(int(some.sum()) + 1) == int(some.sum()))], names=["gram", "n", "all"])

    counted = saved(texts.select("text").mapInArrow(count, "gram long, n long, all boolean").groupBy("gram", "all").agg(F.sum("n").alias("n")))
    total = counted.filter("all").agg(F.sum("n")).first()[0] or 0
    hot = counted.filter("NOT all").filter(F.col("n") > max(least, total // MOST_HOT)).select("gram").collect()
    return np.sort(np.array([r.gram for r in hot], dtype=np.int64).view(U64))


def run_rows(texts: DataFrame, hot: np.ndarray, words: int, gram: int) -> DataFrame:
    """(ord, place, anchor, run, salt) of all runs; ``place`` packs first word, the text's mark and the number of windows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_arrays(batch.column(2))
            mark = batch.column(1).to_numpy()
            for row, begin, windows, anchor, run, alone in each_segment(raw, off, hot, words, gram):
                place = (begin << (MARK_BITS + WINDOW_BITS)) | (mark[row] << WINDOW_BITS) | windows
                salt = np.where(alone, 1 + (mix(mark[row].astype(U64) + begin.astype(U64)) % U64(SALTS)).astype(np.int64), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(place), pa.array(anchor.view(np.int64)),
                     pa.array(run.view(np.int64)), pa.array(salt.astype(np.int32))], names=["ord", "place", "anchor", "run", "salt"])

    return texts.select("ord", "mark", "text").mapInArrow(find, "ord long, place long, anchor long, run long, salt int")


def unpacked(*names: str) -> list[Column]:
    parts = {"start": F.shiftright("place", MARK_BITS + WINDOW_BITS), "windows": F.col("place").bitwiseAND(F.lit((1 << WINDOW_BITS) - 1)),
             "mark": F.shiftright("place", WINDOW_BITS).bitwiseAND(F.lit((1 << MARK_BITS) - 1))}
    return [parts[n].alias(n) for n in names]


def cut_runs(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(anchor, run, ord, n, bytes: the run's words joined by a space) of the listed runs of each text."""
    for batch in batches:
        owners, texts = batch.column(0).to_pylist(), batch.column(1)
        raw, off = text_arrays(texts)
        for i, j in chunks(off, CHUNK_BYTES):
            part = raw[off[i]:off[j]]
            start, end, first = word_borders(part, off[i:j + 1] - off[i])
            data, out = part.tobytes(), []
            for row, listed in enumerate(batch.column(2).slice(i, j - i).to_pylist()):
                for p in listed:
                    a = int(first[row]) + p["start"]
                    b = a + p["windows"] + words - 2
                    out.append((p["anchor"], p["run"], owners[i + row], p["n"], b" ".join(data[start[a]:end[b]].split())))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())],
                                             names=["anchor", "run", "ord", "n", "bytes"])


def first_owners(symbols: np.ndarray, starts: np.ndarray, own: np.ndarray, alphabet: int, words: int,
                 shard_words: int = SHARD_WORDS) -> np.ndarray:
    """Per place the smallest owner of the window that ends there (``own`` where no window ends).

    One anchor's runs can exceed a shard.  Their windows are then split by content into several shards."""
    least = np.repeat(own, np.diff(starts))
    pieces = -(-len(symbols) // (4 * shard_words))
    if pieces == 1:
        index = FMIndex(symbols, starts, own, alphabet, words)
        return index.statistics(symbols, starts, own, words)[1]
    ends = np.flatnonzero(np.arange(len(symbols)) - np.repeat(starts[:-1], np.diff(starts)) >= words - 1)
    key = mix(span_hash(prefix_hash(mix(symbols.astype(U64))), ends - words + 1, ends + 1)) % U64(pieces)
    for piece in range(pieces):
        mine = ends[key == U64(piece)]
        window = symbols[mine[:, None] + np.arange(1 - words, 1)].ravel()
        borders, owner = np.arange(len(mine) + 1) * words, least[mine]
        if len(mine):
            index = FMIndex(window, borders, owner, alphabet, words)
            least[mine] = index.statistics(window, borders, owner, words)[1][words - 1::words]
    return least


def search_shard(rows: list[tuple], words: int, shard_words: int) -> list[tuple]:
    """(anchor, run, [(offset, windows, first)]) of the runs whose windows some text loses."""
    ids: dict[bytes, int] = {}
    listed = [r[4].split(b" ") for r in rows]
    symbols = np.array([ids.setdefault(w, len(ids) + 1) for words_of in listed for w in words_of], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in listed])])
    own = np.array([r[2] for r in rows], dtype=np.int64)
    least = first_owners(symbols, starts, own, len(ids) + 1, words, shard_words)
    new = np.concatenate([[True], least[1:] != least[:-1]])
    out = []
    for (anchor, run, owner, n, _), a, b in zip(rows, starts[:-1].tolist(), starts[1:].tolist()):
        a += words - 1
        cuts = [a, *(a + 1 + np.flatnonzero(new[a + 1:b])).tolist(), b]
        found = [{"offset": x - a, "windows": y - x, "first": int(least[x])} for x, y in zip(cuts, cuts[1:])]
        if n > 1 or len(found) > 1 or found[0]["first"] < owner:
            out.append((anchor, run, found))
    return out


FOUND = "array<struct<offset: int, windows: int, first: bigint>>"


def search(parts: DataFrame, words: int, shard_words: int) -> DataFrame:
    """(anchor, run, found) of the runs; all runs of an anchor lie in one shard."""
    kind = pa.list_(pa.struct([("offset", pa.int32()), ("windows", pa.int32()), ("first", pa.int64())]))

    def work(held: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*search_shard(held, words, shard_words))) or [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], kind)],
                                          names=["anchor", "run", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] == last:
                    continue  # a row that repeats id and text
                if size >= shard_words and row[0] != last[0]:
                    yield work(held)
                    held, size = [], 0
                held.append(row)
                size += row[4].count(b" ") + 1
                last = row[:2]
        if held:
            yield work(held)

    return (parts.select("anchor", "run", "ord", "n", "bytes").repartition("anchor").sortWithinPartitions("anchor", "run")
            .mapInArrow(run, f"anchor long, run long, found {FOUND}"))


CUT_SCHEMA = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start: int, length: int>>"


def cut_out(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))
    for batch in batches:
        raw, off = text_arrays(batch.column(1))
        for i, j in chunks(off, CHUNK_BYTES):
            part = raw[off[i]:off[j]]
            start, end, first = word_borders(part, off[i:j + 1] - off[i])
            data, out = part.tobytes(), []
            for row, lost in enumerate(batch.column(2).slice(i, j - i).to_pylist()):
                a, b = int(first[row]), int(first[row + 1])
                text = data[start[a]:end[b - 1]].split() if b > a else []
                if not lost:
                    out.append((len(text), 0, b" ".join(text), []))
                    continue
                depth = np.zeros(len(text) + 1, dtype=np.int32)
                begin = np.array([p["start"] for p in lost])
                np.add.at(depth, begin, 1)
                np.add.at(depth, begin + np.array([p["windows"] for p in lost]) + words - 1, -1)
                gone = np.cumsum(depth[:-1]) > 0
                out.append((len(text), int(gone.sum()), b" ".join(text[k] for k in np.flatnonzero(~gone).tolist()),
                            [{"start": s, "length": n} for s, n in spans(gone)]))
            n, removed, kept, where = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).view(pa.string()), pa.array(where, kind)], names=["doc_id", "n_words", "n_removed", "kept", "removed"])


def remove_seen(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, gram: int = GRAM,
                hot_runs: int = HOT_RUNS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (words joined by a space), removed (word spans).

    ``words`` is at most 15 (a run's number of windows is packed into four bits)."""
    texts = id_and_text(docs, id_col, text_col).withColumns({"ord": F.coalesce("doc_id", F.lit(LAST)), "mark": text_mark()})
    # 1, 2. Runs whose anchor occurs again; the first of equal ones leads.
    rows = run_rows(texts, hot_grams(texts, words, gram, hot_runs), words, gram)
    whole = "rows between unbounded preceding and unbounded following"
    dealt = rows.repartition("anchor", "salt").selectExpr(
        "*", "row_number() over (partition by anchor, salt, run order by ord, place) = 1 as leads",
        f"count(*) over (partition by anchor, salt, run order by ord, place {whole}) as copies").selectExpr(
        "*", "count(*) over (partition by anchor, salt) as n")
    shared = saved(dealt.filter("n > 1 OR salt > 0").drop("n"))
    leads = shared.filter("leads").groupBy("anchor", "run").agg(
        F.min(F.struct("ord", "place")).alias("one"), F.sum("copies").alias("n"))
    # 3. Their words, shard by shard.
    wanted = (leads.select("anchor", "run", "n", "one.ord", "one.place").select("anchor", "run", "n", "ord", *unpacked("start", "windows", "mark"))
              .groupBy("ord", "mark").agg(F.collect_list(F.struct("start", "windows", "anchor", "run", "n")).alias("listed")))
    parts = texts.join(wanted, ["ord", "mark"]).select("ord", "text", "listed").mapInArrow(
        lambda batches: cut_runs(batches, words), "anchor long, run long, ord long, n long, bytes binary")
    found = saved(search(parts, words, shard_words))
    # 4. Windows that a smaller id has as well.
    salted = shared.select("anchor", "run").filter("salt > 0").distinct().withColumn("salt", F.explode(F.sequence(F.lit(1), F.lit(SALTS))))
    every = found.join(salted, ["anchor", "run"], "left").withColumn("salt", F.coalesce("salt", F.lit(0)))
    lost = (shared.select("ord", "place", "anchor", "run", "salt").join(every, ["anchor", "run", "salt"])
            .select("ord", *unpacked("start", "mark"), F.explode(F.filter("found", lambda f: f["first"] < F.col("ord"))).alias("f"))
            .select("ord", "mark", (F.col("start") + F.col("f.offset")).cast("int").alias("start"), F.col("f.windows").alias("windows")))
    by_text = lost.groupBy("ord", "mark").agg(F.collect_list(F.struct("start", "windows")).alias("lost"))
    return texts.join(by_text, ["ord", "mark"], "left").select("doc_id", "text", "lost").mapInArrow(
        lambda batches: cut_out(batches, words), CUT_SCHEMA)


def op11_substring_dedup(spark, sf_dir: str) -> DataFrame:
    made = remove_seen(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = f"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - {WORDS} + 2)) AS i, w FROM t),
s AS (SELECT doc_id, i, array_to_string(w[i:i + {WORDS - 1}], ' ') AS win FROM p),
f AS (SELECT win, min(doc_id) AS first FROM s GROUP BY win),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WORDS})) AS gone FROM s JOIN f USING (win) WHERE first < doc_id),
l AS (SELECT doc_id, list(gone) AS gone FROM g GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM t LEFT JOIN l USING (doc_id)
"""
