"""Tokenizer alignment against both libraries, text by text."""

from __future__ import annotations

import collections
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedlake.llm import align
from tests.llm.cases import DOCS


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(
        public_tokenizers.path("piece_bpe_32k.model"), "rb"
    ) as g:
        return f.read(), g.read()


def plain(files, texts):
    """Tokens with their byte ranges, and all pairs that overlap, the long way."""
    first, second = Tokenizer.from_str(files[0]), sentencepiece.SentencePieceProcessor(model_proto=files[1])
    first.encode_special_tokens = True
    letters = align._byte_letters()
    out = []
    for text in texts:
        if not text:
            out.append(([], [], []))
            continue
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        data = (" " + text).encode()
        if any(b"".join(x for _, x in side) != data for side in (a, b)):
            out.append(([], [], []))
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        out.append((*spans, links))
    return out


def wanted(files, rows):
    found = dict(zip({t: 0 for _, t in rows}, plain(files, list({t: 0 for _, t in rows}))))
    counts = collections.Counter(p for _, t in rows for p in set(found[t][2]))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for doc_id, text in rows:
        a, b, links = found[text]
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in (a, b)))
            begin = end
        out.append((
            doc_id, len(a), len(b), len(ends), len(links), sum(counts[p] == best[p[0]] for p in links),
            sum(counts[p] for p in links), ";".join(groups),
        ))
    return out


def rows_of(frame):
    return [tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) for r in frame.collect()]


ODD = [
    "a  b", " a", "a ", "\n\n x\n", "▁a ▁ b", "<s> </s> <unk> <0x41>", "x y   z", "日本語 テスト 🙂", "it's they'll ’s",
    "a\x1cb \x85 c　d", "0123 456789", "ﬁ ½ ² ſ", "\x00 \x01", "é é", "don't\tstop\r\n", "Ā ż ɏ ɐ",
]


@pytest.mark.parametrize("sent", [align.MAX_SENT_ROWS, 0])
def test_documents(spark, docs, files, monkeypatch, sent):
    """The same rows whether pair counts are sent to all tasks or joined by a shuffle."""
    monkeypatch.setattr(align, "MAX_SENT_ROWS", sent)
    short = docs.filter("text IS NULL OR length(text) < 3000")
    want = wanted(files, [(r[0], r[1]) for r in DOCS if r[1] is None or len(r[1]) < 3000])
    assert sorted(rows_of(align.align_documents(short, *files)), key=str) == sorted(want, key=str)


def test_odd_and_random_texts(spark, files):
    rnd = random.Random(3)
    letters = "ab cdeéñ.,!'st\n0129 世🙂\t\x1c▁ ß"
    texts = ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    texts += texts[:20] * 3
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(rows_of(align.align_documents(frame, *files))) == sorted(wanted(files, rows))


def test_ranks_cut_as_the_file_does(files):
    aligner = align.Aligner(*files)
    assert aligner.ranked is not None
    rnd = random.Random(4)
    latin = [chr(c) for c in range(1, 0x250)]
    for _ in range(400):
        text = "".join(rnd.choice(latin if rnd.random() < 0.5 else latin[31:126]) for _ in range(rnd.randint(1, 60)))
        assert aligner._first(text) == aligner.a.encode(" " + text, add_special_tokens=False).ids


def test_a_long_text_and_slices(spark, files):
    long = "One of many words, it's ".strip() * 60_000
    found = align.Aligner(*files).align([long, "short", None])
    assert found["n_a"][0] > 100_000 and found["n_groups"][2] == 0
    assert sum(found["times"][0]) >= max(found["n_a"][0], found["n_b"][0])


def test_empty_table(none, files):
    assert align.align_documents(none, *files).count() == 0
