"""Packing against the tokenizer, and the order along the curve."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from feedlake.llm import packing
from tests.llm.cases import DOCS


@pytest.fixture(scope="module")
def library(tokenizer):
    t = Tokenizer.from_str(tokenizer)
    t.encode_special_tokens = True
    return t


def test_pieces_hold_every_document(docs, tokenizer, library):
    rows = packing.pack_documents(docs, tokenizer, sequence=256).collect()
    pieces = {}
    for r in rows:
        assert r["length"] * 4 == len(r["ids"]) and 0 < r["length"] <= 256
        assert r["offset"] + r["length"] <= 256
        place = r["sequence_id"] * 256 + r["offset"]
        pieces[place] = r
    # Sequences are filled without gaps, all but the last.
    at = 0
    for place in sorted(pieces):
        assert place == at
        at += pieces[place]["length"]
    got, run = [], None
    for place in sorted(pieces):
        r = pieces[place]
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        if r["start"] == 0:
            run = [r["doc_id"], r["doc_tokens"], []]
            got.append(run)
        assert r["start"] == len(run[2]) and r["doc_id"] == run[0]
        run[2].extend(ids)
    wanted = [
        (r[0], library.encode(r[1] or "", add_special_tokens=False).ids + [packing.END_ID]) for r in DOCS
    ]
    assert all(n == len(ids) for _, n, ids in got)
    assert sorted(((d, ids) for d, _, ids in got), key=str) == sorted(wanted, key=str)


def test_words_as_the_library_has_them(tokenizer, library):
    words = packing.WordIds(tokenizer, "<u4")
    rnd = random.Random(2)
    letters = "abT é.,!'s t\n01 2\x1c　世İΣ́$`ªº×Àÿ<|>"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 150))) for _ in range(1500)]
    texts += ["<|endoftext|> a<|startoftext|>b", "Don't we'll I'M x's' 'tis", "\r\n a\tb\x0b"]
    for text in texts:
        data = b"".join(map(words.__getitem__, text.replace("\n", " ").split(" ")))
        assert np.frombuffer(data, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3)])
def test_hilbert_curve_is_a_walk(dimensions, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = packing.hilbert_keys(points, bits)
    assert sorted(keys) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_like_documents_lie_together(spark, tokenizer):
    rows = []
    for i in range(200):
        words = ["apple pear plum cherry", "steel iron copper zinc"][i % 2].split()
        rows.append((i, " ".join(random.Random(i).choices(words, k=60))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    packed = packing.pack_documents(df, tokenizer).orderBy("sequence_id", "offset").collect()
    kinds = [r["doc_id"] % 2 for r in packed if r["start"] == 0]
    assert sum(a != b for a, b in itertools.pairwise(kinds)) < 10


def test_empty_table(none, tokenizer):
    assert packing.pack_documents(none, tokenizer).count() == 0
