"""Fingerprints against plain sets of paragraphs."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from feedlake.llm import fingerprints
from tests.llm.cases import DOCS, prose


def word_digests(text):
    """Paragraphs of a text as tuples of words, the long way; cuts are asked of the operator's digest of a word."""
    out = collections.Counter()
    for line in text.split("\n"):
        now = []
        for word in [w for w in _words(line) if w]:
            now.append(word)
            alone = _word_digest(word)
            if alone % fingerprints.CUT_EVERY == 0:
                out[tuple(now)] += 1
                now = []
        if now:
            out[tuple(now)] += 1
    return out


def _words(line):
    for c in "\t\x0b\x0c\r":
        line = line.replace(c, " ")
    return line.split(" ")


def _word_digest(word):
    total, power = 0, 1
    data = word.encode()
    for b in data:
        total = (total + int(fingerprints._LETTERS[b]) * power) % 2**64
        power = power * fingerprints._STEP % 2**64
    return int(fingerprints.mixed(np.array([(total + len(data)) % 2**64], np.uint64))[0])


def plain_likeness(a, b):
    x, y = word_digests(a), word_digests(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 1.0


def wanted(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (doc_id, text), (_, other) in zip(rows, rows[1:] + rows[:1]):
        text, other = text or "", other or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        out.append((doc_id, len(text), edited, round(plain_likeness(text, edited), 12), round(plain_likeness(text, other), 12)))
    return out


def rows_of(frame):
    return [(r[0], r["n_chars"], r["edited_text"], round(r["near_edited"], 12), round(r["near_next"], 12)) for r in frame.collect()]


@pytest.mark.parametrize("per_range", [fingerprints.ROWS_PER_RANGE, 3])
def test_documents(spark, docs, monkeypatch, per_range):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", per_range)
    found = fingerprints.fingerprint_documents(docs)
    assert sorted(rows_of(found), key=str) == sorted(wanted([(r[0], r[1]) for r in DOCS]), key=str)


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "ROWS_PER_RANGE", 5)
    rnd = random.Random(1)
    rows = [(i * 3 if i % 7 else i, prose(i % 40, rnd.randint(0, 60))) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id int, text string").repartition(6)
    found = fingerprints.fingerprint_documents(frame)
    assert dict(found.dtypes)["doc_id"] == "int"
    assert sorted(rows_of(found)) == sorted(wanted(rows))


def test_equal_texts_have_equal_fingerprints(spark, docs):
    by_text = collections.defaultdict(set)
    texts = collections.defaultdict(set)
    for r in DOCS:
        texts[r[0]].add(r[1] or "")
    for r in fingerprints.fingerprint_documents(docs).collect():
        if len(texts[r[0]]) == 1:
            by_text[next(iter(texts[r[0]]))].add(r["fingerprint"])
        by_text[r["edited_text"]].add(r["edited_fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())
    assert len({p for prints in by_text.values() for p in prints}) > 12


def test_differences_come_back_however_many(monkeypatch):
    rnd = np.random.default_rng(2)
    left, right = [], []
    for n in [0, 1, 2, 5, 8, 20, 100, 1000, 20_000]:
        shared = rnd.integers(2**63, size=50, dtype=np.uint64)
        left.append(np.sort(np.concatenate([shared, rnd.integers(2**63, size=n, dtype=np.uint64)])))
        right.append(np.sort(np.concatenate([shared, rnd.integers(2**63, size=n // 3, dtype=np.uint64)])))
    only_left, only_right = fingerprints.differences(left, right)
    for a, b, x, y in zip(left, right, only_left, only_right):
        assert x.tolist() == np.setdiff1d(a, b).tolist() and y.tolist() == np.setdiff1d(b, a).tolist()


def test_a_sketch_tells_what_its_size_allows():
    rnd = np.random.default_rng(3)
    a = rnd.integers(2**63, size=1000, dtype=np.uint64)
    b = np.concatenate([a[:995], rnd.integers(2**63, size=4, dtype=np.uint64)])
    x, y = fingerprints.sketch([a]), fingerprints.sketch([b])
    only_a, only_b, done, _ = fingerprints.peel(fingerprints.subtract(x, y))
    assert done[0] and set(only_a[0].tolist()) == set(a[995:].tolist()) and set(only_b[0].tolist()) == set(b[995:].tolist())


def test_an_edit_changes_only_paragraphs_it_touches():
    text = prose(4, 600)
    words = text.split(" ")
    words[300] = "altogether"
    a, b = fingerprints.paragraphs([text, " ".join(words)])
    assert 0 < len(np.setxor1d(a, b)) <= 6


def test_empty_table(none):
    assert fingerprints.fingerprint_documents(none).count() == 0
