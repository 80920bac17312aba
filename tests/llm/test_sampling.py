"""Importance resampling and fill-in-middle against plain-Python versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import fill_middle, importance


def mixed_texts(n=90):
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "naïve", "日本", "x1", "long" * 30, "a", "Ω", "don't", "e-mail"]
    texts = [None, "", "  ,, ", "<P>", "one <S> two", "x" * 9000, "é" * 5000, "word " * 4000, "a", "\n"]
    for _ in range(n - len(texts)):
        texts.append("".join(rng.choice(vocabulary) + rng.choice([" ", "\n", ", ", "  "]) for _ in range(rng.choice([3, 19, 20, 60, 900]))))
    return texts


def brute_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [zlib.crc32(f) % 10000 for f in words + [a + b" " + b for a, b in zip(words, words[1:])]]


def brute_resample(rows, target):
    corpus, wanted = [0] * 10000, [0] * 10000
    for _, text in rows:
        for b in brute_features(text)[1]:
            corpus[b] += 1
    for text in target:
        for b in brute_features(text)[1]:
            wanted[b] += 1
    s_all, t_all = sum(corpus), sum(wanted)
    out, able = [], []
    for doc_id, text in rows:
        words, found = brute_features(text)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10000) / ((corpus[b] + 1) * (t_all + 10000)))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        row = [doc_id, len(found), weight, score, None]
        out.append(row)
        if len(words) >= 20:
            able.append(row)
    able.sort(key=lambda r: (-r[3], 1 << 70 if r[0] is None else r[0], r[1]))
    for rank, row in enumerate(able[:len(able) * 25 // 100], 1):
        row[4] = rank
    return out


def in_order(rows):
    return sorted(tuple(-(1 << 70) if v is None else v for v in r) for r in rows)


def test_resample_equals_plain_version(spark):
    texts = mixed_texts(240)
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, texts[40]), (None, texts[40])] + [(33, texts[11])] * 3 + [(33, texts[60])]
    target = [None, "", *texts[30:36], "alpha Beta naïve"]
    docs = spark.createDataFrame([(i, t, -1) for i, t in rows], "doc_id long, text string, rank int").repartition(5)
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert in_order(got.collect()) == in_order(brute_resample(rows, target))


def test_resample_without_rows_or_target(spark):
    docs = spark.createDataFrame([(i, "same words " * 12) for i in range(8)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert in_order(importance.resample(docs, none).collect()) == in_order(brute_resample([(i, "same words " * 12) for i in range(8)], []))
    assert importance.resample(docs.limit(0), none).count() == 0
    few = importance.resample(docs.limit(3), none).collect()
    assert len(few) == 3 and all(r.rank is None for r in few)


@pytest.mark.parametrize("k", [1, 2, 499, 1000])
def test_quickselect_finds_every_place(spark, k):
    rng = random.Random(k)
    keys = [(rng.randrange(5), rng.randrange(20), 1, i) for i in range(1000)]
    table = spark.createDataFrame([(key,) for key in keys], "key struct<least: long, id: long, n_features: long, place: long>")
    assert importance.kth_key(table, k, pivots=3) == sorted(keys)[k - 1]


def test_crc_states():
    rng = random.Random(3)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 7, 64, 65, 300]))) for _ in range(200)]
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    got = importance.advance(np.full(len(words), importance.FULL), data, start, end) ^ importance.FULL
    assert got.tolist() == [zlib.crc32(w) for w in words]


def brute_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_fenwick_cuts(block):
    texts = [t or "" for t in mixed_texts()]
    raws = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    got = fill_middle.transform(list(range(len(texts))), np.frombuffer(b"".join(raws), np.uint8), offsets, block=block)
    assert [(n, f, p, m, o.decode()) for n, f, p, m, o in got] == [brute_fill(i, t) for i, t in enumerate(texts)]


def test_fill_middle_rows(spark):
    rows = [(i, t) for i, t in enumerate(mixed_texts())] + [(None, "null id text"), (4, "again"), (4, "again")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, output string").repartition(3)
    made = fill_middle.fill_middle(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert in_order2(made, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back"]) == sorted(
        str([i, *brute_fill(i, t), t or ""]) for i, t in rows)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert fill_middle.fill_middle(docs.limit(0)).count() == 0


def in_order2(rows, columns):
    return sorted(str([r[c] for c in columns]) for r in rows)
