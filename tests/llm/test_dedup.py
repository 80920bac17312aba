import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import exact_dedup, graph, near_dedup, suffix_dedup


def jaccard_classes(texts, k, percent=80):
    """Brute force: smallest reachable id per id over all pairs of shingle sets."""
    import re

    sets = {}
    for i, text in texts.items():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_exact_groups(spark):
    rows = [(1, "Same Text", "x"), (2, "same text", "y"), (3, "SAME TEXT", None), (3, "SAME TEXT", None), (4, "Éa", "x"), (5, "éa", "x"),
            (6, None, "x"), (7, "", "x"), (None, "same text", "x"), (None, "only null id", "x"), (8, "long " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, norm string")
    got = sorted(exact_dedup.exact_groups(docs).collect(), key=str)
    assert len(got) == len(rows)
    assert sum(r.kept for r in got if r.keep_id == 3) == 1
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} >= {
        (1, 3, 5), (2, 3, 5), (3, 3, 5), (4, 4, 1), (5, 5, 1), (6, 7, 2), (7, 7, 2), (None, 3, 5), (None, None, 1), (8, 8, 1)}
    assert {r.text_sha256 for r in got if r.doc_id == 4} == {hashlib.sha256("Éa".encode()).hexdigest()}
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_exact_hot_group_is_sliced(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(
        F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_groups(docs).toPandas()
    hot = got[got.doc_id % 3 == 0]
    assert (hot.keep_id == 2997).all() and (hot.group_size == 1000).all() and hot.kept.sum() == 1
    assert (got[got.doc_id % 3 != 0].group_size == 1).all() and got.kept.sum() == 2001


def test_components(spark):
    rng = random.Random(4)
    for n, m in ((1, 0), (30, 20), (200, 190), (60, 400)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(1000, 1040)]
        got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        parent = {}

        def root(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        touched = {x for a, b in edges if a != b for x in (a, b)}
        assert got == {x: root(x) for x in touched}


def near_texts():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = {}
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 40, 120, 300]))]
        for _ in range(rng.choice([1, 2, 10, 40])):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts[len(texts) * 7 + 3] = (" " if group % 2 else "\n").join(words)
    return texts | {100_000: "", 100_001: None, 100_002: "one two", 100_003: "ONE\ttwo", 100_004: " \n "}


@pytest.mark.parametrize("k", [4, 5])
def test_near_classes(spark, k):
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, component int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_classes(docs, k=k).collect()}
    assert got == jaccard_classes(texts, k)
    kept = near_dedup.drop_near_copies(docs, k=k)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, (_, c) in got.items() if i == c}


def test_near_classes_tell_regular_words_apart(spark):
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    texts = {i: " ".join([w] * 3 + tail) for i, (w, tail) in enumerate([(one, ["x", "y"]), (other, ["x", "y"]), (one, ["x", "y"])])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_classes(docs).collect()} == jaccard_classes(texts, 4)


def test_near_rows_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e", 7, 8), (2, "a b c d e", 7, 8)], "doc_id long, text string, dropped_id long, component_id long")
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c d e", 7, 8)]


def test_near_edge_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, None), (2, "a b c d e")], "doc_id long, text string")
    got = sorted(near_dedup.near_classes(docs).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got].count((1, 1, True)) == 2
    assert [(r.doc_id, r.component_id, r.kept) for r in got].count((None, None, True)) == 2
    assert (2, 1, False) in [(r.doc_id, r.component_id, r.kept) for r in got]
    assert near_dedup.near_classes(docs.limit(0)).count() == 0


def brute_repeats(texts, length):
    seen = {}
    raws = [(t or "").encode() for t in texts]
    for d, raw in enumerate(raws):
        for s in range(len(raw) - length + 1):
            seen.setdefault(raw[s:s + length], []).append((d, s))
    gone = [np.zeros(len(r), dtype=bool) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for d, s in places:
                gone[d][s:s + length] = True
    return [(len(r), int(g.sum()), len(suffix_dedup.spans(g)), bytes(np.frombuffer(r, np.uint8)[~g])) for r, g in zip(raws, gone)]


def repeat_texts():
    rng = random.Random(8)
    letters = "abcdé "
    random_text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [random_text(rng.choice([20, 25, 31, 60, 120])) for _ in range(6)]
    texts = ["", None, "short", "x" * 100, "ab" * 70, random_text(300)]
    for _ in range(60):
        parts = [rng.choice([random_text(rng.randint(0, 50)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 5):]]) for _ in range(4)]
        texts.append("".join(parts))
    return texts + [texts[-1], texts[5]]


@pytest.mark.parametrize("most", [500_000, 40])
def test_suffix_dedup(spark, most):
    texts = repeat_texts()
    docs = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, start string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, length=25, keep_text=True, most_suffixes=most).collect()
    expected = sorted((i if i % 9 else -1, *row) for i, row in enumerate(brute_repeats(texts, 25)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == expected
    for r in got:
        assert r.kept_sha256 == hashlib.sha256(r.kept).hexdigest() and sum(s.length for s in r.spans) == r.n_removed


@pytest.mark.parametrize("most", [4, 60, 100_000])
def test_suffix_dedup_hot_anchor(spark, most):
    """One line that many texts share between different words: wide blocks, parts that stay wide, and all in one sort."""
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    line, tail = word(95), word(40)
    texts = [word(rng.randint(0, 30)) + line + word(rng.randint(0, 30)) for _ in range(40)]
    texts += [word(9) + line + tail[:rng.randint(0, 40)] for _ in range(20)] + ["z" * 7 + line * 3, "x" * 150]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(docs, length=100, keep_text=True, most_suffixes=most).collect()
    expected = [(i, *row) for i, row in enumerate(brute_repeats(texts, 100))]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == expected


def test_blocks_of_equal_windows_share_a_key(spark):
    rng = random.Random(12)
    line = bytes(rng.choice(b"abcdefgh") for _ in range(130))
    raw = np.frombuffer(b"before " + line + b" after", dtype=np.uint8)
    row, start, windows, _, _ = suffix_dedup.runs(np.concatenate([raw, raw[3:]]), np.array([0, len(raw), 2 * len(raw) - 3]), 100)
    whole = np.concatenate([raw, raw[3:]]).tobytes()
    pieces = [(True, int(r), 0, int(s), bytearray(whole[s:s + w + 99])) for r, s, w in zip(row, start, windows)]
    df = spark.createDataFrame(pieces, "single boolean, doc_id long, text_hash long, start int, bytes binary")
    keys, seen = {}, 0
    for block in suffix_dedup.split_runs(df, 100).collect():
        for i in range(len(block.bytes) - 99):
            seen += 1
            assert keys.setdefault(bytes(block.bytes[i:i + 100]), block.anchor) == block.anchor
    assert seen == int(windows.sum()) and len(set(keys.values())) > 1


def test_suffix_dedup_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "q" * 3 + "0123456789abcdefghij" * 30), (1, "q" * 3 + "0123456789abcdefghij" * 30), (2, "z" * 399)], "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in got) == [(1, 603, 603), (1, 603, 603), (2, 399, 0)]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_blind_trie_groups_equal_strings():
    rng = random.Random(2)
    for _ in range(200):
        codes = [bytes(rng.choice(b"ab") for _ in range(6)) for _ in range(rng.randint(1, 30))]
        groups = sorted(sorted(g) for g in suffix_dedup.blind_trie(codes, 6))
        assert groups == sorted([i for i, c in enumerate(codes) if c == code] for code in set(codes))


def test_long_text_segments(spark, monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    texts = [text + text[100:900], text[1500:2500]]
    offsets = np.array([0, 3800])
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 500)
    whole = suffix_dedup.runs(np.frombuffer(texts[0].encode(), np.uint8), offsets, 25)
    parts = [suffix_dedup.runs(np.frombuffer(texts[0].encode(), np.uint8)[lo:hi], np.clip(offsets[i:j + 1], lo, hi) - lo, 25)
             for i, j, lo, hi in suffix_dedup.segments(offsets, 25)]
    assert len(parts) > 5 and sum(int(p[2].sum()) for p in parts) == int(whole[2].sum()) == 3800 - 24
