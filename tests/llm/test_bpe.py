"""Tree concatenation against the library on whole texts, and exact round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", "'s", "'", "ll", "!", "!!", " ", "  ", "\n", "\t", "é", "日本", "👩‍🚀", "12", "3", "<|endoftext|>", "<|endof",
         "text|>", " ", " ", "\x1c", "zzzz", "ing", "==", "-", "a" * 40, " " * 9, "0" * 17, "́"]


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH)


def whole(codec, text):
    return codec.tokenizer.encode(text, add_special_tokens=False).ids


def texts(seed, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_tree_of_tiny_leaves_is_the_encoding_of_the_whole(codec):
    for text in texts(1, 1500, 40):
        assert codec.tree(text, 5).tolist() == whole(codec, text), text


def test_pieces_are_the_encoding_of_the_whole(codec):
    samples = texts(2, 1500, 60)
    for text, ids in zip(samples, codec.encode(samples), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole(codec, text), text
        assert codec.decode(ids) == text


def test_pieces_that_come_again_are_looked_up(codec, monkeypatch):
    sample = texts(3, 300, 60) + ["", " ", "x" * 9000 + " y" * 50, "the cat " * 400, "the cat " * 400]
    want = [whole(codec, text) for text in sample]
    codec.kept.clear()
    got = [codec.encode([text])[0] for text in sample]
    assert codec.kept and max(map(len, codec.kept)) <= bpe.KEPT_CHARS
    asked, library = [], codec._bytes
    monkeypatch.setattr(codec, "_bytes", lambda pieces: asked.extend(pieces) or library(pieces))
    assert codec.encode(sample) == got == [np.array(ids, "<u4").tobytes() for ids in want]
    assert all(len(p) > bpe.KEPT_CHARS for p in asked)
    monkeypatch.setattr(bpe, "KEPT", 50)
    assert [codec.encode([text])[0] for text in sample] == got


def test_join_grows_over_a_long_run(codec):
    for unit in ("a", "ab", " ", "\n", "=", "0", "é", "日"):
        for n in (100, 1001, 3000):
            assert codec.tree(unit * n, 64).tolist() == whole(codec, unit * n)


def test_decoding_of_broken_characters_is_the_library_s(codec):
    rng = random.Random(5)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert codec.decode(np.array(ids, "<u4").tobytes()) == codec.tokenizer.decode(ids, skip_special_tokens=False)


def test_rows_with_nulls_repeats_and_long_texts(spark, codec):
    long = ("word, " * 50 + "x" * 700 + "<|endoftext|>" * 3 + "é日\n\n  ") * 3
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, long), (5, long * 2), (5, "y" * 2000)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, ids string, row string")
    got = bpe.decode(bpe.encode(docs, PATH, split_chars=300), PATH).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = [(i, whole(codec, t or ""), t or "") for i, t in rows]
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["text"]) for r in got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(docs, PATH).collect() == []


def test_query_is_the_library_on_whole_texts(spark, codec):
    import hashlib

    rows = bpe.op9_bpe(spark, "/root/testdata/sf0.001").collect()
    texts = dict(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect())
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(whole(codec, texts[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(codec.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()).hexdigest()
