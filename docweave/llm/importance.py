"""Operator 12, target-distribution importance resampling.

Features of a text are its words and pairs of neighbouring words; a feature falls in the
bucket crc32(feature) mod ``BUCKETS``.  A bucket's gain is the (floored) log ratio of its smoothed share in
the target texts to that in the corpus, a document's weight the mean gain of its features, and its
score the weight plus Gumbel noise drawn from a hash of its id: drawing the highest scores samples
documents without replacement in proportion to their importance.

1. Both bucket counts come from maps that add up whole tasks in one array and emit at most
   ``BUCKETS`` rows per task; the driver holds the ``BUCKETS`` sums.
2. One map scores all documents: crc32 states of all words of a batch advance together,
   a byte per step over arrays, and a pair continues the first word's state.
3. Distributed quickselect finds the k-th key of the order (score descending, then id, number of features,
   place in the scored table, which makes keys unique).  A round draws ``PIVOTS`` random keys of the range that is
   left, counts exactly how many keys lie below and at each (one aggregation), and keeps
   the part between two pivots that holds the k-th; rounds grow with the logarithm of the number of rows.
4. Winners alone are range-partitioned and sorted; a rank is the rows of earlier partitions (one count per
   partition) plus the place in the own one, so no task ever sees all winners.

Defined results: null and empty texts have no feature and weight 0; a null id is hashed as an empty
one and comes after all ids among ties; repeated rows are drawn each on their own; only documents
of at least ``LEAST_WORDS`` words can be drawn; without target texts all target counts are 0; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import ASCII_LOWER, CHUNK_BYTES, chunks, edges, text_arrays
from .work import id_and_text, saved

BUCKETS = 10_000
LEAST_WORDS = 20
DRAW_PERCENT = 25
SEED = 7
PIVOTS = 31
LONG_WORD = 64  # longer words are hashed one by one
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = crc_table()
FULL = np.uint32(0xFFFFFFFF)


def advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 states (before the final inversion) after reading data[start:end], all spans a byte per step."""
    size = end - start
    order = np.argsort(-np.minimum(size, LONG_WORD + 1), kind="stable")  # the spans still being read come first
    long = int((size > LONG_WORD).sum())
    out, order = state.copy(), order[long:]
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes(), int(state[i] ^ FULL)) ^ 0xFFFFFFFF
    now, begin, size = state[order], start[order], size[order]
    lengths = np.bincount(size, minlength=1)
    active = len(size)
    for step in range(len(lengths) - 1):
        active -= int(lengths[step])
        now[:active] = CRC[(now[:active] ^ data[begin[:active] + step]) & np.uint32(0xFF)] ^ (now[:active] >> np.uint32(8))
    out[order] = now
    return out


def feature_buckets(raw: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features in row order (words, then pairs, of each row apart), the rows of the features, and words per row."""
    low = ASCII_LOWER[raw]
    start, end = edges(IN_WORD[low], offsets)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    one = advance(np.full(len(start), FULL), low, start, end)
    head = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.empty(0, np.int64)
    gap = CRC[(one[head] ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (one[head] >> np.uint32(8))
    two = advance(gap, low, start[head + 1], end[head + 1])
    return (np.concatenate([one ^ FULL, two ^ FULL]) % np.uint32(buckets)).astype(np.int64), np.concatenate([row, row[head]]), np.diff(first)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            raw, off = text_arrays(batch.column(0))
            for i, j in chunks(off, CHUNK_BYTES):
                found, _, _ = feature_buckets(raw[off[i]:off[j]], off[i:j + 1] - off[i], buckets)
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    sums = np.zeros(buckets, dtype=np.int64)
    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in rows.collect():  # at most ``buckets`` rows
        sums[bucket] = n
    return sums


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ratio) of the smoothed shares, in doubles."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(texts: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score per row, and ``place``, a number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            raw, off = text_arrays(batch.column(1))
            for i, j in chunks(off, CHUNK_BYTES):
                ids, rows = batch.column(0).slice(i, j - i), j - i
                buckets, row, words = feature_buckets(raw[off[i]:off[j]], off[i:j + 1] - off[i], len(gains))
                n = np.bincount(row, minlength=rows)
                total = np.zeros(rows, dtype=np.int64)
                np.add.at(total, row, gains[buckets])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                scores = weight + np.array([noise(d, seed) for d in ids.to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(weight), pa.array(scores),
                     pa.array(place + np.arange(rows))], names=["doc_id", "n_words", "n_features", "weight", "score", "place"])
                place += rows

    return texts.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long, place long")


#: The order of the draw; keys are unique by their last part.
KEY = ["least", "id", "n_features", "place"]


def order_key() -> Column:
    return F.struct((-F.col("score")).alias("least"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "n_features", "place")


def literal(key: tuple) -> Column:
    return F.struct(*[F.lit(int(v)).cast("long").alias(name) for name, v in zip(KEY, key)])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> tuple:
    """The k-th smallest (from 1) of the unique ``key`` structs, by quickselect over the table."""
    draw = random.Random(seed)
    left, right = None, None  # the k-th key lies strictly between these
    while True:
        part = keys
        if left is not None:
            part = part.filter(F.col("key") > literal(left))
        if right is not None:
            part = part.filter(F.col("key") < literal(right))
        salt = draw.getrandbits(60)
        picked = sorted(tuple(r.key) for r in part.orderBy(F.xxhash64(F.lit(salt), "key.place")).limit(pivots).collect())
        listed = F.array(*[literal(p) for p in picked])  # folded to one constant, so every round has the same code
        below = F.size(F.filter(listed, lambda p: p < F.col("key")))
        counts = {(r.below, r.at): r.n for r in part.groupBy(below.alias("below"), F.array_contains(listed, F.col("key")).alias("at"))
                  .agg(F.count("*").alias("n")).collect()}  # at most two rows per pivot
        for i in range(len(picked) + 1):
            between, at = counts.get((i, False), 0), counts.get((i, True), 0)
            if k <= between:
                left, right = (picked[i - 1] if i else left), (picked[i] if i < len(picked) else right)
                break
            if k <= between + at:
                return picked[i]
            k -= between + at


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = DRAW_PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null if not drawn)."""
    texts = id_and_text(docs, id_col, text_col)
    wanted = target.select(F.coalesce(target[target_text].cast("string"), F.lit("")).alias("text"))
    gains = bucket_gains(bucket_counts(texts, buckets), bucket_counts(wanted, buckets))
    scored = saved(score(texts, gains, seed)).withColumn("key", order_key())
    able = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score"]
    k = scored.filter(able).count() * percent // 100
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = able & (F.col("key") <= literal(kth_key(scored.filter(able).select("key"), k, seed=seed)))
    ordered = saved(scored.filter(drawn).repartitionByRange("key").sortWithinPartitions("key")
                    .select(*columns, F.monotonically_increasing_id().alias("at")))
    part = F.shiftright("at", 33)
    sizes = sorted(ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row per partition
    before, passed = [], 0
    for p, n in sizes:
        before.append((p, passed))
        passed += n
    offsets = docs.sparkSession.createDataFrame(before, "part long, passed long")
    ranked = (ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
              .select(*columns, (F.col("passed") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("rank")))
    return ranked.unionAll(scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def op12_importance(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
