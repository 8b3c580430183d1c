"""Byte-level BPE against the library that the rank file belongs to."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken

from feedlake.llm import bpe
from tests.llm.cases import DOCS


@pytest.fixture(scope="module")
def data():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(data):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(data), special_tokens={}
    )


def test_documents(spark, docs, data, library):
    encoded = bpe.encode_documents(docs, data, public_tokenizers.PATTERN)
    rows = bpe.decode_documents(encoded, data).collect()
    wanted = [(r[0], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in DOCS]
    got = [(r["doc_id"], r["ids"], bytes(r["bytes"])) for r in rows]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_random_and_long_pieces(data, library):
    rnd = random.Random(1)
    letters = "ab cdeéñ.,!'st\n0129 世🙂\t\x1c "
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 300))) for _ in range(400)]
    texts += ["ab" * bpe.MAX_ROW, "a" * (bpe.MAX_ROW + 1), " " * 3000, "é" * 2000, "1" * 1500, "the" * 700]
    texts += ["x" * n for n in range(bpe.MAX_ROW - 2, bpe.MAX_ROW + 3)]
    encoder = bpe.TextEncoder(bpe.read_ranks(data), public_tokenizers.PATTERN)
    import numpy as np

    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(text), text[:40]


def test_both_ways_of_merging_agree(data):
    encoder = bpe.Encoder(bpe.read_ranks(data))
    rnd = random.Random(2)
    for _ in range(60):
        piece = bytes(rnd.choice(b"theinasr ") for _ in range(rnd.randint(1, 200)))
        assert encoder.encode([piece])[0].tolist() == encoder._by_heap(piece).tolist()


def test_a_small_cache_changes_nothing(data, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    encoder = bpe.TextEncoder(bpe.read_ranks(data), public_tokenizers.PATTERN)
    import numpy as np

    for text in ("one two three four five", "one two six", "five four three"):
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode_ordinary(text)


def test_empty_table(none, data):
    encoded = bpe.encode_documents(none, data, public_tokenizers.PATTERN)
    assert bpe.decode_documents(encoded, data).count() == 0
