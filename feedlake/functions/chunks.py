"""Overlapping word windows and token estimates, as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import fixed
from feedlake.functions.text import words


@dataclass(frozen=True)
class ChunkSpec:
    size: int  # words per window
    overlap: int  # words shared by neighbours
    keep_blank: bool = True  # text of only white space gives one empty window

    @property
    def step(self) -> int:
        return max(self.size - self.overlap, 1)

    @classmethod
    def from_tokens(cls, size: int, overlap: int) -> ChunkSpec:
        def in_words(tokens: int, floor: int) -> int:
            return max(int(tokens * fixed.WORDS_PER_TOKEN), floor)

        return cls(
            in_words(size, fixed.MIN_CHUNK_WORDS), in_words(overlap, fixed.MIN_OVERLAP_WORDS)
        )


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside a lambda Spark would otherwise evaluate it for every element.
    """
    return F.transform(F.array(value), body).getItem(0)


def chunk_structs(text: Column, spec: ChunkSpec, blanks_only: bool = False) -> Column:
    """``array<struct<chunk_text, n_words>>``: all windows of a text, in order.

    Windows start at 0, step, 2*step and so on up to the first that reaches the
    end, so a text of n words has 1 + max(0, ceil((n - size) / step)) of them.
    ``blanks_only`` says that blanks are the only white space in the text.
    """

    def windows(ws: Column) -> Column:
        n = F.size(ws)
        last = F.greatest(F.ceil((n - spec.size) / F.lit(spec.step)), F.lit(0)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(
                F.array_join(F.slice(ws, i * spec.step + 1, spec.size), " ").alias("chunk_text"),
                F.least(F.lit(spec.size), n - i * spec.step).alias("n_words"),
            ),
        )

    empty = F.array().cast("array<struct<chunk_text:string,n_words:int>>")
    chunks = bind(words(text, blanks_only), windows)
    if not spec.keep_blank:
        chunks = F.filter(chunks, lambda c: c["n_words"] > 0)
    return F.when(F.coalesce(text, F.lit("")) == "", empty).otherwise(chunks)


def chunk_windows(text: Column, spec: ChunkSpec) -> Column:
    """``array<string>``: the texts of all windows."""
    return chunk_structs(text, spec).getField("chunk_text")


def tokens_of_words(n_words: Column) -> Column:
    return F.greatest(F.floor(n_words / F.lit(fixed.WORDS_PER_TOKEN)), F.lit(1)).cast("int")


def token_estimate(text: Column) -> Column:
    """0 for no text, else at least 1 token, at three words to four tokens."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(
        tokens_of_words(F.size(words(text)))
    )
