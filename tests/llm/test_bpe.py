import hashlib
import random

import numpy as np
import pytest

from peerwatch.llm.bpe import Bpe, default_vocabulary, encode_documents

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def pair():
    from tokenizers import Tokenizer

    return Bpe(default_vocabulary()), Tokenizer.from_file(default_vocabulary())


def texts(seed=7, n=1500):
    rng = random.Random(seed)
    letters = "aaaeeiioottnnsshhrrdllcum  \n\t'.,0123456789éñß漢字🙂  \u0085\x1c\x1f\x0b²½Ⅷ__-́​﻿"
    words = ["the", " the", "'s", "'ll", "don't", "<|endoftext|>", "<|endof", "   ", "\r\n", "ing", "ciónmente", "èeux", "heitkeit"]
    for _ in range(n):
        yield "".join(rng.choice(letters) if rng.random() < 0.8 else rng.choice(words) for _ in range(rng.randrange(80)))
    yield "a" * 20_000
    yield "ab" * 5_000 + "!" * 3_000 + " " * 999
    yield "".join(rng.choice("etaoinshr") for _ in range(30_000))


def test_as_the_library(pair):
    bpe, library = pair
    for text in texts():
        ids = np.frombuffer(bpe.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:200]
        assert bpe.decode(np.asarray(ids, "<u4").tobytes(), window=1 << 20) == library.decode(ids, skip_special_tokens=False) == text


def test_caches_may_be_emptied(pair, monkeypatch):
    bpe, library = pair
    monkeypatch.setattr(bpe.seen, "room", 3)
    text = "one two three four five six one two"
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library.encode(text).ids


def test_documents(spark, pair):
    rows = [(1, None, 0), (2, "", 1), (3, "Hello world", 2), (3, "Hello world", 2), (None, "é", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_documents(docs).collect())
    want = []
    for doc, text, _ in rows:
        ids = pair[1].encode(text or "").ids
        want.append((doc or 0, len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert encode_documents(docs.limit(0)).count() == 0
