import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import language, toxicity
from docweave.llm.arrays import text_arrays
from docweave.llm.letters import Words

NEUTRAL = ["river", "market", "window", "paper", "yellow", "garden", "music", "winter", "letter", "doctor", "bread", "city"]
RUDE = ["idiot", "scumbag", "worthless", "pathetic"]


def held(doc_id, parts, rest):
    return zlib.crc32(str(doc_id).encode()) % parts == rest


@pytest.fixture(scope="module")
def toxic_tables(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        words = [rng.choice(NEUTRAL) for _ in range(30)]
        if toxic:
            words[rng.randrange(30)] = rng.choice(RUDE)
        # Group mentions come mostly with toxic labels, which a plain classifier would learn.
        if rng.random() < (0.6 if toxic else 0.02):
            words[rng.randrange(30)] = "muslims"
        docs.append((i, " ".join(words), "x", 0.0))
        labels.append((i, 1, int(toxic)))
    labels += [(5, 0, None), (None, 0, 1), (7, 1, 0), (99_999, 0, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, score string, toxic double"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_learns_and_ignores_groups(spark, toxic_tables):
    docs, labels = toxic_tables
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).toPandas()
    assert (got.held_out == [held(i, 5, 0) for i in got.doc_id]).all()
    out = got[got.held_out]
    assert (out.predicted == (out.doc_id % 4 == 0)).mean() > 0.98
    probe = spark.createDataFrame([(1, "music for muslims and christians in the city"), (2, "music for christians and muslims in the city"),
                                   (3, "Muslims"), (4, "christians"), (5, "You IDIOT!"), (6, None), (7, ""), (7, ""), (None, "idiot"),
                                   (8, "river " * 60_000)], "doc_id long, text string")
    rows = toxicity.score(probe, model).collect()
    scores = {r.doc_id: r.score for r in rows}
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert abs(scores[3] - scores[4]) < 0.05 and scores[3] < 0.5 and scores[1] < 0.5
    assert scores[5] >= 0.5 and scores[None] >= 0.5 and scores[8] < 0.5
    plain = toxicity.fit(docs, labels, pair_weight=0.0)
    gap = {r.doc_id: r.score for r in toxicity.score(probe, plain).collect()}
    assert abs(gap[3] - gap[4]) > abs(scores[3] - scores[4])


def letter_words(text):
    return [w.lower() for w in re.findall(r"[^\W\d_]+", text or "")]


def key_of(word, salt=0):
    raw, off = text_arrays(pa.array([word]))
    found = Words(raw, off)
    return int(found.hash(found.start, found.end, salt)[0])


def test_toxicity_scores_equal_a_plain_version(spark, toxic_tables):
    docs, labels = toxic_tables
    keys, weights, bias = model = toxicity.fit(docs, labels)
    weight = dict(zip(keys.tolist(), weights.tolist()))
    for r in toxicity.score(docs.limit(300), model).join(docs.select("doc_id", "text"), "doc_id").collect():
        features = {key_of(w) for w in letter_words(r.text)} | {
            key_of(w[:n], n) for w in letter_words(r.text) for n in toxicity.HEADS if len(w) > n}
        assert r.score == pytest.approx(1 / (1 + math.exp(-(bias + sum(weight.get(f, 0.0) for f in features)))), abs=1e-9)


def test_toxicity_without_labels(spark, toxic_tables):
    docs, labels = toxic_tables
    model = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs.limit(20), model).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    kept = toxicity.score(docs.limit(5), model, keep_rows=True).select("row.*")
    assert kept.columns == docs.columns


def test_swapped_terms():
    assert toxicity.swapped("The women, and MEN-folk", toxicity.SWAP) == "The men, and women-folk"


def plain_language(model, text):
    """Language and score by the model's tables, a word at a time."""
    def known(kind, key):
        at, row = model.tables[kind].find(np.array([key], dtype=np.uint64))
        return model.logs[kind][row[0]] if len(at) else None

    words = letter_words(text)
    sums = np.log(model.priors)
    for w in words:
        one = known(0, key_of(w))
        if one is None:
            one = np.zeros(len(model.languages))
            raw, off = text_arrays(pa.array([w]))
            for n in language.GRAMS:
                hits = [x for x in (known(n, int(g)) for g in language.grams(Words(raw, off), np.array([0]), n)[1]) if x is not None]
                if hits:
                    one = sum(hits)
                    break
        sums = sums + one
    if not words:
        return "und", 0.0
    return model.languages[int(sums.argmax())], float(1 / np.exp((sums - sums.max()) / math.sqrt(len(words))).sum())


def test_language_held_out(spark):
    rng = random.Random(3)
    sounds = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["schn", "ei", "gro", "ß"], "zz": ["ção", "ñe", "llu", "ar"]}
    word = lambda lang: "".join(rng.choice(sounds[lang]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(400):
        lang = rng.choice(sorted(sounds))
        rows.append((i, " ".join(word(lang) for _ in range(rng.randint(2, 40))).upper() if i % 5 == 0 else " ".join(word(lang) for _ in range(20)), lang))
    extra = [(1000, None, "xx"), (1001, "", None), (1002, "12 !! 34", "yy"), (1003, "kalo " * 40_000, None), (None, "schnei", "yy"), (3, rows[3][1], rows[3][2])]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["xx", "yy", "zz"]
    got = language.predict(docs, model).toPandas()
    assert len(got) == len(rows) + len(extra)
    by_id = got.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    assert all(by_id.held_out[i] == held(i, 4, 2) for i, _, _ in rows)
    out = [(by_id.lang_pred[i], lang) for i, _, lang in rows if held(i, 4, 2)]
    assert len(out) > 50 and all(a == b for a, b in out)
    assert [by_id.lang_pred[i] for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "xx"]
    for i, text, _ in rows[:150]:
        lang, score = plain_language(model, text)
        assert by_id.lang_pred[i] == lang and by_id.score[i] == pytest.approx(score, abs=1e-9)
    assert by_id.score[1000] == 0 and got.score.between(0, 1).all()
    assert language.predict(docs.limit(0), model).count() == 0
    none = language.fit(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language.predict(docs.limit(9), none).collect()} == {("und", 0.0)}
