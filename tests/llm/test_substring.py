"""Substring dedup by FM-indexes against plain-Python versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import arrays, substring_dedup
from docweave.llm.fm_index import FMIndex, WaveletMatrix


def brute(rows, words):
    listed = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    ords = [1 << 63 if i is None else i for i, _ in rows]
    first = {}
    for o, w in zip(ords, listed):
        for i in range(len(w) - words + 1):
            key = tuple(w[i:i + words])
            first[key] = min(o, first.get(key, o))
    out = []
    for (doc_id, _), o, w in zip(rows, ords, listed):
        gone = {k for i in range(len(w) - words + 1) if first[tuple(w[i:i + words])] < o for k in range(i, i + words)}
        out.append((doc_id, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(map(str, out))


def repeated_rows(seed, size=140):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "b", "naïve", "日本", "x" * 5000, "c.", "don't", *[f"w{i}" for i in range(40)]]
    passage = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [passage(n) for n in (4, 6, 8, 12, 13, 14, 30, 80)] + [["a"] * 60, ["a", "b"] * 40]
    rows = [(9, None), (11, ""), (12, " \n "), (13, "a b"), (7, "a " * 3000)]
    for i in range(size):
        parts = [x for _ in range(rng.randint(1, 5)) for x in (passage(rng.randint(0, 9)), rng.choice(shared)[rng.randint(0, 3):])]
        rows.append((rng.choice([None, 3, 3, i * 5, i * 5]), rng.choice([" ", "\n", "  ", "\t "]).join(w for p in parts for w in p)))
    return rows + rows[-6:] + [(1000, rows[20][1]), (0, rows[21][1])]


@pytest.mark.parametrize("words, gram, hot, shard", [(5, 2, 2000, 200_000), (5, 2, 6, 60), (13, 3, 3, 40), (13, 3, 2000, 200_000)])
def test_remove_seen(spark, words, gram, hot, shard):
    rows = repeated_rows(words + hot)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, ord int, anchor int").repartition(4)
    got = substring_dedup.remove_seen(docs, words=words, gram=gram, hot_runs=hot, shard_words=shard).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in got) == brute(rows, words)
    assert all(sum(s.length for s in r.removed) == r.n_removed for r in got)


def test_query_on_a_table(spark, tmp_path):
    rows = repeated_rows(1, 30)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = substring_dedup.op11_substring_dedup(spark, str(tmp_path)).collect()
    expected = [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in [(1000, "")]]
    assert len(got) == len(rows) and expected[0][0] in {r.doc_id for r in got}
    assert substring_dedup.remove_seen(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_grams_are_passed_over(spark):
    line = " ".join(f"l{i}" for i in range(9))
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(
        F.md5(F.col("id").cast("string")), F.lit(f" {line} "), F.md5((F.col("id") + 1000).cast("string")), F.lit(" "),
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.md5((F.col("id") * 100 + i).cast("string"))), " ")).alias("text"))
    texts = docs.withColumns({"ord": F.col("doc_id"), "mark": substring_dedup.text_mark()})
    hot = substring_dedup.hot_grams(texts, 13, 3, least=100)
    assert 0 < len(hot) <= 9
    most = substring_dedup.run_rows(texts, hot, 13, 3).groupBy("anchor").count().agg(F.max("count")).first()[0]
    assert most <= 100 < substring_dedup.run_rows(texts, hot[:0], 13, 3).groupBy("anchor").count().agg(F.max("count")).first()[0]


def test_wavelet_ranks():
    rng = np.random.default_rng(4)
    for alphabet, n in ((2, 1), (5, 64), (300, 1000)):
        values = rng.integers(0, alphabet, n)
        tree = WaveletMatrix(values, alphabet)
        symbols, at = rng.integers(0, alphabet, 200), rng.integers(0, n + 1, 200)
        got = tree.places(symbols, at) - tree.places(symbols, np.zeros(200, np.int64))
        assert got.tolist() == [int((values[:a] == s).sum()) for s, a in zip(symbols, at)]


def test_matching_statistics():
    rng = random.Random(6)
    texts = [[rng.randint(1, 3) for _ in range(rng.randint(1, 30))] for _ in range(25)]
    owner = np.array([rng.randrange(12) for _ in texts])
    symbols, starts = np.array([x for t in texts for x in t]), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for depth in (3, 5, 8):
        index = FMIndex(symbols, starts, owner, 4, depth)
        length, least = index.statistics(symbols, starts, owner, depth)
        for t, o, a in zip(texts, owner, starts):
            for e in range(depth - 1, len(t)):
                pattern = t[e - depth + 1:e + 1]
                met = [int(p) for u, p in zip(texts, owner) for i in range(len(u) - depth + 1) if u[i:i + depth] == pattern]
                assert least[a + e] == min(met)
                longest = max(n for n in range(depth + 1) if n == 0 or sum(
                    u[i:i + n] == t[e - n + 1:e + 1] for u in texts for i in range(len(u) - n + 1)) > 1)
                assert length[a + e] == longest


def test_span_digests_tell_regular_words_apart():
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one = bytes(97 + b for b in bits)
    other = bytes(98 - b for b in bits)
    words = [b"", b"a", b"a\0", one, other, one * 3, other * 3, one[:8], one[:7]]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    got = arrays.span_digests(data, end - [len(w) for w in words], end)
    assert len(set(got.tolist())) == len(words)
    assert got[0] == arrays.span_digests(data, np.array([5]), np.array([5]))[0]
