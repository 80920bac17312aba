import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import packing, tokens
from docweave.llm.arrays import chunks, text_arrays

ALPHABET = ["a", "b", "s", "t", "re", "ve", "ll", "m", "d", "'", "'", " ", " ", "\n", "\t", "1", "23", "é", "漢", "字",
            "!", "..", "😀", "<|endoftext|>", "<|endof", "́", " ", "I", "'s", "\x00", "½", "aaaaaaa", "\r\n"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.tokenizer_path())


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", None, "<|endoftext|>"]


def test_ids_equal_the_library(library):
    texts = random_texts(4000)
    raw, off = text_arrays(pa.array(texts))
    model = tokens.merges_of(tokens.tokenizer_path())
    at = 0
    for i, j in chunks(off, 5000):
        counts, flat = tokens.row_tokens(model, raw[off[i]:off[j]], off[i:j + 1] - off[i], True)
        for n in counts:
            assert flat[:n].tolist() == library.encode(texts[at] or "", add_special_tokens=False).ids, texts[at]
            flat, at = flat[n:], at + 1
    assert at == len(texts)


def thue_morse(letters, n=2048):
    """A word and its complement: equal under every polynomial hash modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return ["".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)]


@pytest.mark.parametrize("letters", ["th", "in", "=-"])
def test_regular_words_are_told_apart(library, letters):
    texts = thue_morse(letters)
    raw, off = text_arrays(pa.array(texts))
    counts, flat = tokens.row_tokens(tokens.merges_of(tokens.tokenizer_path()), raw, off, True)
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in ids] and flat.tolist() == ids[0] + ids[1]


def test_counts_query(spark, library):
    docs = spark.createDataFrame([(1, "Hello world's", "x"), (1, "Hello world's", "x"), (None, "", "y"), (3, None, None),
                                  (4, "word " * 3000, "z")], "doc_id long, text string, n_tokens string")
    rows = sorted(tokens.token_counts(docs).collect(), key=str)
    assert len(rows) == 5
    for r in rows:
        text = {1: "Hello world's", None: "", 3: "", 4: "word " * 3000}[r.doc_id]
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text), n, n > 1024)
    assert tokens.token_counts(docs.limit(0)).count() == 0


def test_pack_fills_windows():
    rng = random.Random(5)
    for _ in range(50):
        lengths = [rng.choice([1, 5, 100, 128, 129, 700, 1023, 1024, 1025, 5000, rng.randint(1, 3000)]) for _ in range(rng.randint(1, 60))]
        seen = {d: [] for d in range(len(lengths))}
        for size, pieces in packing.pack(lengths):
            assert size & (size - 1) == 0 and size <= 1024 and sum(p[2] for p in pieces) == size
            for d, s, n in pieces:
                seen[d].append((s, n))
        for d, parts in seen.items():
            end = 0
            for s, n in sorted(parts):
                assert s == end and n > 0
                end = s + n
            assert end == lengths[d]


def test_packing_query(spark, library):
    texts = random_texts(300, seed=9) + ["long text " * 2000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, offset string").repartition(3)
    pieces = packing.pack_documents(docs).toPandas()
    assert set(pieces.doc_id) == set(range(len(texts)))
    for doc_id, own in pieces.groupby("doc_id"):
        ids = np.array(library.encode(texts[doc_id] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        own = own.sort_values("start")
        assert own.start.tolist() == np.concatenate([[0], np.cumsum(own.length)[:-1]]).tolist()
        assert own.length.sum() == len(ids) and (own.doc_tokens == len(ids)).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    for _, seq in pieces.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq.offset.tolist() == np.concatenate([[0], np.cumsum(seq.length)[:-1]]).tolist()
        assert seq.length.sum() == seq.window.iloc[0]
    steps = pieces.groupby("step_id").length.sum()
    assert steps.max() <= packing.STEP_TOKENS + 2 * packing.WINDOW
    assert packing.pack_documents(docs.limit(0)).count() == 0
