"""Operator 5, language identification by word-first backoff.

Model: per language the log frequency of known words, and of character
4-, 3-, 2- and 1-grams (word borders included).  A text's words are scored one
by one: a known word by its own log frequencies; an unseen one by its 4-grams, and
only if none of those is known by its 3-grams, then 2-grams, then single
characters.  Word scores add up per language, and the best sum wins.

The model is learned from a bounded sample, ``SAMPLE`` texts per language on average (a hash of
the id below the share that gives that many; all texts of rarer languages),
counted in Spark.  Words and n-grams seen at least twice are kept, all of them, of rare languages as of
others; the sample bounds what is sent to the tasks.  Distinct words of a chunk are scored once.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is
every text if no language was learned; ties go to the language first in
alphabetical order; rows with null lang or null id are predicted, null ids are
not learned from; repeated rows are predicted each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import CHUNK_BYTES, U64, chunks, mix, prefix_hash, span_hash, text_arrays
from .letters import Table, Words
from .work import crc_bucket, id_and_text, saved

SAMPLE = 2000  # texts per language that are learned from, on average
GRAMS = (4, 3, 2, 1)
FOLDS, HELD_OUT = 4, 2
MARK = 0x2E  # stands for a word border in n-grams; never a letter


def grams(words: Words, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``which``, hash) of the n-grams of the words, borders marked for n > 1."""
    start, size = words.start[which], (words.end - words.start)[which]
    pad = 1 if n > 1 else 0
    total = size + 2 * pad
    owner = np.repeat(np.arange(len(which)), total)
    begin = np.cumsum(total) - total
    inner = np.arange(len(owner)) - begin[owner]
    if not len(owner):
        return owner, np.empty(0, U64)
    source = np.clip(start[owner] + inner - pad, 0, len(words.points) - 1)
    points = words.points[source].copy()
    if pad:
        points[(inner == 0) | (inner == total[owner] - 1)] = MARK
    at = np.flatnonzero(inner + n <= total[owner])
    prefix = prefix_hash(points)
    return owner[at], mix(span_hash(prefix, at, at + n) + U64(n << 32))


def entries(raw: np.ndarray, offsets: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """kind -> (hashes, counts) over all rows; kind 0 are words."""
    words = Words(raw, offsets)
    hashes, sample, counts = np.unique(words.hashes, return_index=True, return_counts=True)
    out = {0: (hashes, counts)}
    for n in GRAMS:
        owner, g = grams(words, sample, n)
        kinds, inverse = np.unique(g, return_inverse=True)
        out[n] = (kinds, np.bincount(inverse, counts[owner], minlength=len(kinds)).astype(np.int64))
    return out


class Model:
    """Per kind a key table and a (keys x languages) matrix of log frequencies."""

    def __init__(self, languages: list[str], priors: np.ndarray, counts: pd.DataFrame):
        self.languages, self.priors, self.tables, self.logs = languages, priors, {}, {}
        column = {lang: i for i, lang in enumerate(languages)}
        for kind in (0, *GRAMS):
            part = counts[counts.kind == kind]
            keys, row = np.unique(part.h.to_numpy(np.int64).view(U64), return_inverse=True)
            table = np.zeros((len(keys), len(languages)))
            np.add.at(table, (row, part.lang.map(column).to_numpy(np.int64)), part.n.to_numpy(np.float64))
            self.tables[kind] = Table(keys)
            self.logs[kind] = np.log((table + 0.5) / (table.sum(axis=0) + 0.5 * (len(keys) + 1)))

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: index of the best language, score, whether there is any letter."""
        words = Words(raw, offsets)
        hashes, sample, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        value = np.zeros((len(hashes), len(self.languages)))
        at, key = self.tables[0].find(hashes)
        value[at] = self.logs[0][key]
        open_ = np.ones(len(hashes), dtype=bool)
        open_[at] = False
        for n in GRAMS:
            todo = np.flatnonzero(open_)
            owner, g = grams(words, sample[todo], n)
            hit, key = self.tables[n].find(g)
            for lang in range(len(self.languages)):
                value[todo, lang] += np.bincount(owner[hit], self.logs[n][key, lang], minlength=len(todo))
            open_[todo[np.unique(owner[hit])]] = False
        first, counts = words.first[:-1], np.diff(words.first)
        some = counts > 0
        sums = np.tile(np.log(self.priors), (len(first), 1))
        if some.any():
            for lang in range(len(self.languages)):
                sums[some, lang] += np.add.reduceat(value[inverse, lang], first[some])
        best = sums.argmax(axis=1)
        # Softmax of the sums, cooled by the square root of the number of words.
        cooled = (sums - sums.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(counts, 1))[:, None]
        return best, 1 / np.exp(cooled).sum(axis=1), some


def fit(docs: DataFrame, sample: int = SAMPLE, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model | None:
    named = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["lang"].cast("string").alias("lang"))
    known = named.filter("doc_id IS NOT NULL AND lang IS NOT NULL").filter(crc_bucket(F.col("doc_id"), folds) != held_out)
    share = known.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)  # uniform in [0, 1)
    chosen = saved(known.join(F.broadcast(share), "lang").filter(draw < F.col("share")).select("doc_id", "lang").distinct())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                raw, off = text_arrays(batch.column(1).filter(pa.array(langs == lang)))
                for i, j in chunks(off, CHUNK_BYTES):
                    for kind, (h, n) in entries(raw[off[i]:off[j]], off[i:j + 1] - off[i]).items():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(h), pa.string()), pa.array(np.full(len(h), kind, np.int32)),
                             pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "kind", "h", "n"])

    rows = (id_and_text(docs).join(chosen, "doc_id").select("lang", "text")
            .mapInArrow(count, "lang string, kind int, h long, n long"))
    counted = saved(rows.groupBy("kind", "h", "lang").agg(F.sum("n").alias("n")))
    twice = counted.groupBy("kind", "h").agg(F.sum("n").alias("total")).filter("total >= 2").select("kind", "h")
    languages = sorted(r.lang for r in chosen.select("lang").distinct().collect())
    if not languages:
        return None
    sizes = {r.lang: r.n for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    priors = np.array([sizes[x] for x in languages], dtype=np.float64)
    return Model(languages, priors / priors.sum(), counted.join(twice, ["kind", "h"], "left_semi").toPandas())


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
            folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = text_arrays(batch.column(1))
            for i, j in chunks(off, CHUNK_BYTES):
                if model is None:
                    names, score = ["und"] * (j - i), np.zeros(j - i)
                else:
                    best, score, some = model.predict(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                    names = np.where(some, np.array(model.languages, dtype=object)[best], "und")
                    score = np.where(some, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"])

    found = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", (crc_bucket(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score")


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, fit(docs))
