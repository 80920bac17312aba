"""Operator 2, toxicity: a counterfactual-regularised logistic classifier.

Features of a text are the presence of its lower-cased letter words and of their
4- to 7-letter beginnings (inflected forms share those).  Fitting uses a bounded sample of
labelled rows (``SAMPLE`` per label, chosen by a hash of the id); features
whose frequencies differ significantly between the labels (z >= ``LEAST_Z``) enter the
model, plus those of identity terms.  For every sampled text with identity
terms a counterfactual is made by swapping each term with its counterpart, and the
squared change of the logit is penalised, so a group mention by itself
moves no score.  Scoring is one map over all texts.

Defined results: null and empty texts score as the bias alone says; labels are reduced
to one per id (the larger one); null labels and ids are not learned from; without labels
every score is 0; repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import CHUNK_BYTES, U64, chunks, text_arrays
from .letters import Table, Words
from .work import crc_bucket, id_and_text, saved, session_limits

#: Most rows of each label that are learned from; bounds the driver's training data.
SAMPLE = 5000
LEAST_Z = 4.5
HEADS = (4, 5, 6, 7)
FOLDS = 5
ROUNDS = 300
L2 = 1e-4
PAIR_WEIGHT = 5.0
#: Identity terms and their counterparts.
IDENTITY_PAIRS = [
    ("men", "women"), ("man", "woman"), ("boys", "girls"), ("boy", "girl"), ("male", "female"), ("fathers", "mothers"),
    ("christian", "muslim"), ("christians", "muslims"), ("jewish", "buddhist"), ("jews", "hindus"), ("catholic", "protestant"),
    ("black", "white"), ("blacks", "whites"), ("african", "european"), ("asian", "american"), ("latino", "indian"),
    ("gay", "straight"), ("gays", "heterosexuals"), ("lesbian", "heterosexual"), ("transgender", "cisgender"),
    ("immigrant", "citizen"), ("immigrants", "citizens"), ("refugees", "residents"), ("disabled", "healthy"), ("old", "young"),
]
SWAP = {a: b for x, y in IDENTITY_PAIRS for a, b in ((x, y), (y, x))}


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of every word and word beginning, repeats included."""
    words = Words(raw, offsets)
    rows = words.rows()
    all_rows, all_hashes = [rows], [words.hashes]
    for n in HEADS:
        at = np.flatnonzero(words.end - words.start > n)
        all_rows.append(rows[at])
        all_hashes.append(words.hash(words.start[at], words.start[at] + n, salt=n))
    return np.concatenate(all_rows), np.concatenate(all_hashes)


def row_features(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct feature hashes of each text."""
    raw, off = text_arrays(pa.array(texts, pa.string()))
    rows, hashes = features(raw, off)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    keep = np.ones(len(rows), dtype=bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return np.split(hashes[keep], np.searchsorted(rows[keep], np.arange(1, len(texts))))


def swapped(text: str, swap: dict[str, str]) -> str:
    return re.sub(r"[^\W\d_]+", lambda m: swap.get(m[0].lower(), m[0]), text)


def training_rows(docs: DataFrame, labels: DataFrame, swap: dict[str, str], sample: int, folds: int) -> DataFrame:
    """(toxic, feats, other) of a bounded sample: features of the text and of its counterfactual."""
    texts = id_and_text(docs)
    known = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .filter(crc_bucket(F.col("doc_id"), folds) != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = known.join(texts.select("doc_id").filter("doc_id IS NOT NULL").distinct(), "doc_id", "left_semi")
    known = saved(known)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(sample).unionAll(
        known.filter("toxic = 0").orderBy(*order).limit(sample))  # at most 2 * sample small rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                own = part.column(1).to_pylist()
                other = [swapped(t, swap) for t in own]
                feats = row_features(own)
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([f.view(np.int64) for f in feats], pa.list_(pa.int64())),
                    pa.array([g.view(np.int64) if o != t else None for o, t, g in zip(other, own, row_features(other))],
                             pa.list_(pa.int64()))], names=["toxic", "feats", "other"])

    return (texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text")
            .mapInArrow(extract, "toxic int, feats array<long>, other array<long>"))


def fit(docs: DataFrame, labels: DataFrame, pairs: list[tuple[str, str]] = IDENTITY_PAIRS, sample: int = SAMPLE,
        folds: int = FOLDS, pair_weight: float = PAIR_WEIGHT) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature hashes, weights, bias)."""
    swap = {a: b for x, y in pairs for a, b in ((x, y), (y, x))}
    rows = saved(training_rows(docs, labels, swap, sample, folds))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return np.empty(0, U64), np.empty(0), -np.inf
    counted = (rows.select("toxic", F.explode("feats").alias("f")).groupBy("f")
               .agg(F.sum("toxic").alias("p"), F.count("*").alias("n")))
    share = F.col("n") / F.lit(float(pos + neg))
    z = F.abs(F.col("p") / pos - (F.col("n") - F.col("p")) / neg) / F.sqrt(share * (1 - share) * (1.0 / pos + 1.0 / neg) + 1e-12)
    picked = counted.filter((F.col("n") >= 5) & (z >= LEAST_Z)).select("f")
    identity = {int(h) for words in row_features(sorted(swap)) for h in words.view(np.int64)}
    chosen = np.array(sorted({r.f for r in picked.collect()} | identity), dtype=np.int64)
    table = Table(chosen.view(U64))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def index(column: pa.Array) -> pa.Array:
            return pa.array([None if x is None else table.find(np.array(x, dtype=np.int64).view(U64))[1].astype(np.int32)
                             for x in column.to_pylist()], pa.list_(pa.int32()))

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), index(part.column(1)), index(part.column(2))],
                                                 names=["toxic", "feats", "other"])

    data = rows.mapInArrow(narrow, "toxic int, feats array<int>, other array<int>").toPandas()
    weights, bias = descend(data, len(chosen), pair_weight)
    return chosen.view(U64), weights, bias


def descend(data, n_features: int, pair_weight: float) -> tuple[np.ndarray, float]:
    """Full-batch Adam on log loss + L2 + pair_weight * mean squared logit change under the swap."""
    y = data.toxic.to_numpy(np.float64)
    row = np.repeat(np.arange(len(data)), data.feats.map(len))
    col = np.concatenate([*data.feats, np.empty(0, np.int32)]).astype(np.int64)
    paired = data[data.other.notna()]
    p_row = np.repeat(np.arange(len(paired)), paired.feats.map(len) + paired.other.map(len))
    p_col = np.concatenate([*(np.concatenate([a, b]) for a, b in zip(paired.feats, paired.other)), np.empty(0, np.int32)]).astype(np.int64)
    p_sign = np.concatenate([*(np.repeat([-1.0, 1.0], [len(a), len(b)]) for a, b in zip(paired.feats, paired.other)), np.empty(0)])
    w, m, v = (np.zeros(n_features + 1) for _ in range(3))
    balance = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for t in range(1, ROUNDS + 1):
        logit = np.bincount(row, w[col], minlength=len(y)) + w[-1]
        slope = balance * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        grad = np.append(np.bincount(col, slope[row], minlength=n_features) + L2 * w[:-1], slope.sum())
        if len(paired):
            change = np.bincount(p_row, p_sign * w[p_col], minlength=len(paired))
            grad[:-1] += 2 * pair_weight / len(paired) * np.bincount(p_col, p_sign * change[p_row], minlength=n_features)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text",
          folds: int = FOLDS, keep_rows: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted per row; with ``keep_rows`` the input row in ``row``."""
    keys, weights, bias = model

    at_id, at_text = docs.columns.index(id_col), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(keys)
        for batch in batches:
            whole = batch.column(0)  # the row, which holds the text once
            raw, off = text_arrays(whole.field(at_text).cast(pa.string()))
            for i, j in chunks(off, CHUNK_BYTES):
                rows, hashes = features(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                at, index = table.find(hashes)
                pairs = np.unique(rows[at] * max(1, len(keys)) + index)
                logit = np.bincount(pairs // max(1, len(keys)), weights[pairs % len(keys)] if len(keys) else None,
                                    minlength=j - i) + bias
                with np.errstate(over="ignore"):
                    yield pa.RecordBatch.from_arrays(
                        [whole.field(at_id).slice(i, j - i).cast(pa.int64()), *([whole.slice(i, j - i)] if keep_rows else []),
                         pa.array(1 / (1 + np.exp(-logit)))], names=out)

    session_limits(docs.sparkSession)
    source = docs.select(F.struct(*[docs[c] for c in (docs.columns if keep_rows else (id_col, text_col))]).alias("row"))
    if not keep_rows:
        at_id, at_text = 0, 1
    out = ["doc_id", *(["row"] if keep_rows else []), "score"]
    row_type = f"row {source.schema['row'].dataType.simpleString()}, " if keep_rows else ""
    scored = source.mapInArrow(run, f"doc_id long, {row_type}score double")
    return scored.select(
        "doc_id", (crc_bucket(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), *(["row"] if keep_rows else []))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
