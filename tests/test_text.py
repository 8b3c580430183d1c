"""Text and chunk expressions on literal inputs, and properties of random ones."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions import text as t
from feedlake.functions.chunks import ChunkSpec, chunk_windows, token_estimate
from feedlake.profiles import CLUSTER, LOCAL

EDGES = [
    None, "", "   ", "\n a \t", "Über café — naïve", "a\x0bb", "a  -  b", "x" * 50, "x" * 51,
    "a b c", "\x1cq\x1d", "Ünï_code 1.5, \"q\" 'r' <b>&amp;</b>", "日本語 テスト", "a​b",
    "½ ² Ⅷ x́", "line\r\nline\n\n end ", "　wide　", "tab\tonly", "[b]racket^\\s",
]


def run(spark, values, **columns):
    df = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)], "i int, text string"
    ).select("i", *[c.alias(n) for n, c in columns.items()])
    return [r.asDict() for r in df.orderBy("i").collect()]


# text: cleaned to ASCII, cleaned with all scripts, words, tokens
CLEANED = {
    None: (None, None, None, 0),
    "": ("", "", [], 0),
    "   ": ("", "", [], 1),
    "\n a \t": (" a ", "a", ["a"], 1),
    "Über café — naïve": ("ber caf  nave", "Über café  naïve", ["Über", "café", "—", "naïve"], 5),
    "a\x0bb": ("a b", "a b", ["a", "b"], 2),
    "a  -  b": ("a - b", "a - b", ["a", "-", "b"], 4),
    "a b c": ("a b c", "a b c", ["a", "b", "c"], 4),
    "Ünï_code 1.5, \"q\" 'r' <b>&amp;</b>": (
        "n_code 1.5, \"q\" 'r' bamp;b", "Ünï_code 1.5, \"q\" 'r' bamp;b",
        ["Ünï_code", "1.5,", '"q"', "'r'", "<b>&amp;</b>"], 6,
    ),
    "日本語 テスト": (" ", "日本語 テスト", ["日本語", "テスト"], 2),
    "line\r\nline\n\n end ": ("line line end", "line line end", ["line", "line", "end"], 4),
    "[b]racket^\\s": ("brackets", "brackets", ["[b]racket^\\s"], 1),
}


def test_literal_texts(spark):
    c = F.col("text")
    rows = run(
        spark, list(CLEANED), ascii=t.normalize_text(c), uni=t.normalize_text(c, unicode=True),
        words=t.words(c), tokens=token_estimate(c),
    )
    for (text, (ascii_text, unicode_text, words, tokens)), row in zip(CLEANED.items(), rows):
        got = (row["ascii"], row["uni"], row["words"], row["tokens"])
        assert got == (ascii_text, unicode_text, words, tokens), repr(text)


def test_hashes(spark):
    digests = {
        "abc": "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad",
        " ABC\n": "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad",
        "a \t b": "c8687a08aa5d6ed2044328fa6a697ab8e96dc34291e8c2034ae8c38e6fcc6d65",
        "A B": "c8687a08aa5d6ed2044328fa6a697ab8e96dc34291e8c2034ae8c38e6fcc6d65",
        "": "", None: "",
    }
    rows = run(spark, list(digests), hash=t.content_hash(F.col("text")))
    assert [r["hash"] for r in rows] == list(digests.values())


# Letters whose lower case differs between Unicode versions are not of interest here.
CHARS = st.characters(blacklist_categories=("Cs", "Cn", "Co"), max_codepoint=0x2FFF).filter(
    lambda c: c not in "\x00İΣ"
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(CHARS | st.sampled_from(" \t\n\x0b\x1c\x85 ab.-"), max_size=40),
                min_size=30, max_size=60))
def test_cleaning_holds_its_promises(spark, values):
    c = F.col("text")
    once = t.normalize_text(c, unicode=True)
    rows = run(
        spark, values, once=once, twice=t.normalize_text(t.squeeze(once), unicode=True),
        ascii=t.normalize_text(c), words=t.words(c), squeezed=t.squeeze(c), hash=t.content_hash(c),
        same=t.content_hash(t.squeeze(F.upper(F.lower(c)))),
    )
    for text, row in zip(values, rows):
        # What is kept stands in the text, in order; words are the text without its white space.
        left = iter(text)
        assert all(x.isspace() or x in left for x in row["ascii"]), repr(text)
        assert all(x.isspace() or ord(x) < 128 for x in row["ascii"])
        assert row["squeezed"] == " ".join(row["words"])
        assert "".join(row["words"]) == "".join(x for x in text if not x.isspace()), repr(text)
        # Cleaning a cleaned and squeezed text changes nothing.
        assert " ".join(row["once"].split()) == row["twice"], repr(text)


def test_blanks_only_is_the_same_for_cleaned_text(spark):
    cleaned = t.normalize_text(F.col("text"))
    rows = run(
        spark, EDGES, a=t.content_hash(cleaned), b=t.content_hash(cleaned, blanks_only=True),
        c=t.words(cleaned), d=t.words(cleaned, blanks_only=True),
    )
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in rows)


def test_picks_and_tags(spark):
    df = spark.createDataFrame(
        [("", "s", "t", "EN"), (None, "", "t", None), (None, None, None, "")],
        "body string, summary string, title string, hint string",
    )
    fields = [F.col(c) for c in ("body", "summary", "title")]
    rows = df.select(
        t.first_present(*fields).alias("a"), t.first_present(*fields, skip_empty=True).alias("b"),
        t.language_tag(F.col("hint")).alias("l"), t.language_tag(F.col("hint"), True).alias("m"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("", "s", "en", "en"), ("", "t", "unknown", "unknown"), (None, "", "", "unknown"),
    ]


def test_specs():
    assert (CLUSTER.chunks.size, CLUSTER.chunks.overlap, CLUSTER.chunks.step) == (384, 48, 336)
    assert (LOCAL.chunks.size, LOCAL.chunks.overlap, LOCAL.chunks.step) == (380, 60, 320)
    assert ChunkSpec.from_tokens(1, 1) == ChunkSpec(50, 10)
    assert ChunkSpec(10, 20).step == 1


@pytest.mark.parametrize("spec", [CLUSTER.chunks, LOCAL.chunks, ChunkSpec(5, 2), ChunkSpec(3, 3)])
def test_windows(spark, spec):
    counts = [0, 1, 2, 3, 4, 5, 6, 9, 379, 380, 381, 383, 384, 385, 700, 701, 720, 721, 5184]
    if spec.size < 10:
        counts = counts[:8] + [50, 51]
    texts = [None, "", "  \t"] + ["  ".join(f"w{i}" for i in range(n)) for n in counts[1:]]
    rows = run(spark, texts, chunks=chunk_windows(F.col("text"), spec))
    for text, row in zip(texts, rows):
        n = len(text.split()) if text else 0
        if not n:
            assert row["chunks"] == ([""] if text and spec.keep_blank else [])
            continue
        # As few windows as cover the text, all full but the last.
        sizes = [len(c.split()) for c in row["chunks"]]
        assert len(sizes) == 1 + max(0, -(-(n - spec.size) // spec.step))
        assert sizes[:-1] == [spec.size] * (len(sizes) - 1) and 0 < sizes[-1] <= spec.size
        # The windows without their overlaps make up the text.
        rebuilt = row["chunks"][0].split()
        for i, chunk in enumerate(row["chunks"][1:], 1):
            rebuilt = rebuilt[: i * spec.step] + chunk.split()
        assert rebuilt == text.split()


def test_expected_chunk_counts(spark):
    texts = [" ".join(["w"] * n) for n in (383, 384, 385, 720, 721, 5184)]
    rows = run(spark, texts, n=F.size(chunk_windows(F.col("text"), CLUSTER.chunks)))
    assert [r["n"] for r in rows] == [1, 1, 2, 2, 3, 16]
