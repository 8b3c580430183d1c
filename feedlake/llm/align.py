"""Alignment of two tokenizers' tokens over the same bytes.

Equal texts are tokenised once: rows are shuffled by their full text, each distinct text
is cut by both tokenizers and aligned, and its pair counts weigh as much as the text has
rows. What is measured on a text then goes to all rows that hold it, by a digest.

Tokens of both kinds cover the same bytes. Where tokens of both end, a group ends; two
tokens are linked if their bytes overlap.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlake.llm.common import byte_slices
from feedlake.session import broadcast_if_small, materialize

SPACE = "▁"  # how a piece shows a space
ALIGNED_BYTES = 1 << 20  # of texts that are aligned together, or one longer text; takes some hundred times as much memory
MAX_SENT_ROWS, MAX_SENT_BYTES = 1_000_000, 64 << 20  # pair counts sent to all tasks; more are joined by a shuffle

# Fixed value: the pattern that cuts text before the merges of a byte-level vocabulary.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, and the bytes of their tokens.

    Merges of the byte-level vocabulary are ranked by their ids where its file lists them so; texts
    of Latin letters, whose classes no library reads differently, are then cut by ranks, which
    is faster. All others are cut by the file's own library.
    """

    def __init__(self, byte_level: str, pieces: bytes):
        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.ranked = self._ranked(json.loads(byte_level))
        # An id with what stands behind it: another id of its group and kind, the other kind, the next group.
        self.shown = [f"{i}{c}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for c in ",|;"]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def _ranked(self, file: dict) -> tiktoken.Encoding | None:
        """The same cuts by ranks, where the file's merges make ids in rising order."""
        model, before = file["model"], file.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        merges = [m if isinstance(m, str) else " ".join(m) for m in model.get("merges", ())]
        made = [model["vocab"].get(m.replace(" ", "", 1), -1) for m in merges]
        if not plain or file.get("normalizer") or any(j <= i for i, j in itertools.pairwise(made)):
            return None
        special = {t["id"] for t in file.get("added_tokens", ())}
        ranks = {self.a_bytes[i]: i for i in model["vocab"].values() if i not in special}
        return tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def _first(self, text: str) -> list[int]:
        """Ids of the text behind a space, by the byte-level vocabulary."""
        if self.ranked is not None and not _BEYOND_LATIN.search(text):
            return self.ranked.encode_ordinary(" " + text)
        return self.a.encode(" " + text, add_special_tokens=False).ids

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Both kinds of ids of each text; none where it is null or empty, or not what the tokens' bytes give."""
        out: list[tuple[list[int], list[int]]] = []
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            a = self._first(text) if text else []
            data = (" " + text).encode() if text else b""
            same = b"".join([self.a_bytes[i] for i in a]) == data == b"".join([self.b_bytes[i] for i in b])
            out.append((a, b) if same else ([], []))
        return out

    def align(self, texts: list[str | None]) -> dict[str, list]:
        """Per text its numbers of tokens and groups, its groups as `a1,a2|b1;a3|b2,b3`, and its
        distinct links with how often each is there. A link is the first id, shifted by 32 bits,
        and the second."""
        found = self.tokens(texts)
        n_a, n_b = ([len(x[k]) for x in found] for k in (0, 1))
        a, b = (np.array(list(itertools.chain.from_iterable(x[k] for x in found)), np.int64) for k in (0, 1))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        # Tokens of both kinds are laid end to end over the same bytes; every text ends a group.
        # Between neighbouring ends of either kind lies just one token of each: a link.
        ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        again = np.append(ends[1:] == ends[:-1], False)[: len(ends)]
        both, ends = ends[again], ends[~again]
        links = a[np.searchsorted(a_ends, ends)] << 32 | b[np.searchsorted(b_ends, ends)]
        # A group's first kind, then its second.
        group = np.concatenate([np.searchsorted(both, a_ends) * 2, np.searchsorted(both, b_ends) * 2 + 1])
        order = np.argsort(group, kind="stable")
        group, ids = group[order], np.concatenate([a, b])[order]
        last = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
        pieces = [self.shown[i] for i in (ids * 3 + np.where(last, 1 + (group & 1), 0)).tolist()]
        at_a, at_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
        byte = np.concatenate([[0], a_ends])[at_a]  # where texts end
        at_group, at_link = np.searchsorted(both, byte, "right"), np.searchsorted(ends, byte, "right")
        at = (at_a + at_b).tolist()
        pairs = [np.unique(links[i:j], return_counts=True) for i, j in itertools.pairwise(at_link.tolist())]
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": np.diff(at_group).tolist(),
            "groups": ["".join(pieces[i:j])[:-1] for i, j in itertools.pairwise(at)],
            "pairs": [p for p, _ in pairs], "times": [n for _, n in pairs],
        }


def align_texts(docs: DataFrame, byte_level: str, pieces: bytes, text_col: str = "text") -> DataFrame:
    """(digest, copies, n_a, n_b, n_groups, groups, pairs, times) of every distinct text.

    `byte_level` is the content of a tokenizer file with a byte-level vocabulary, `pieces` that
    of a piece model. `copies` is the number of rows with the text, `pairs` its distinct links
    and `times` how often each is there. Null and empty texts have no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level, pieces)
        for batch in batches:
            for part in byte_slices(batch, 0, ALIGNED_BYTES):
                found = aligner.align(part.column(0).to_pylist())
                at = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in found["pairs"]])]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(at, pa.array(np.concatenate(found[k]).astype(np.int64)))
                    for k in ("pairs", "times")
                ]
                numbers = [pa.array(found[k], pa.int64()) for k in ("n_a", "n_b", "n_groups")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), *numbers, pa.array(found["groups"], pa.string()), *lists],
                    ["digest", "copies", "n_a", "n_b", "n_groups", "groups", "pairs", "times"],
                )

    text = F.col(f"`{text_col}`")
    distinct = docs.filter(text != "").groupBy(text.alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    return distinct.select("text", _digest(F.col("text")).alias("digest"), "copies").mapInArrow(
        run,
        "digest binary, copies long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<long>",
    )


def _digest(text: F.Column) -> F.Column:
    return F.unhex(F.sha2(text, 256))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): in how many rows a link stands, and whether its first id has none that stands in more."""
    counts = materialize(
        aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("count")),
        "pair_counts",
    )
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    return counts.join(broadcast_if_small(most), first == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best")
    )


def align_documents(
    docs: DataFrame, byte_level: str, pieces: bytes, id_col: str = "doc_id", text_col: str = "text",
    shown: Callable[[F.Column], F.Column] = lambda groups: groups,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    The first tokenizer cuts the text behind a space, the second, which adds one, the text; the
    strings of special tokens are plain text. `groups` names the ids of each group in order;
    `shown` of it is kept, for instance a digest. `n_best` counts the links that stand in as many
    rows as any link of the same first id, `count_sum` adds up for all links in how many rows
    they stand. A row counts as a document, also where rows or ids are repeated or the id is
    null. Rows whose text is null or empty, or not just what the tokens' bytes give, have zeros
    and ''. Texts of any length are taken whole, other columns are ignored, and an empty table
    gives no rows.

    Disk holds each distinct text once in its shuffle, and its distinct links once. Counts are
    added up before they are shuffled. They go to all tasks while they are few, as the
    vocabularies allow; else distinct links are shuffled to them, where adaptive execution
    splits frequent ones.
    """
    aligned = align_texts(docs, byte_level, pieces, text_col).withColumn("groups", shown(F.col("groups")))
    aligned = materialize(aligned.withColumn("number", F.monotonically_increasing_id()), "aligned")
    counts = broadcast_if_small(pair_counts(aligned), MAX_SENT_ROWS, MAX_SENT_BYTES)
    links = aligned.select("number", F.explode(F.arrays_zip("pairs", "times")).alias("l"))
    sums = (
        links.select("number", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
        .join(counts, "pair").groupBy("number").agg(
            F.sum("times").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    plain = ["n_a", "n_b", "n_groups"]
    summed = ["n_links", "n_best", "count_sum"]
    measures = aligned.filter("n_groups > 0").select("number", "digest", *plain, "groups").join(sums, "number")
    rows = docs.select(
        F.col(f"`{id_col}`"), F.when(F.col(f"`{text_col}`") != "", _digest(F.col(f"`{text_col}`"))).alias("digest")
    )
    # A digest that many rows share is split by adaptive execution: the other side has it once.
    return rows.join(measures, "digest", "left").select(
        F.col(f"`{id_col}`"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in plain + summed],
        F.coalesce("groups", F.lit("")).alias("groups"),
    )
