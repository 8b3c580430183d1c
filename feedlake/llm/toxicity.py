"""Toxicity by a linear classifier on character n-grams.

Features are the distinct hashed n-grams of a text, each scaled by its naive Bayes
log-count ratio between toxic and other texts; a logistic regression with an absolute
penalty on the scaled features leaves few weights. Training takes a bounded sample of
labelled rows; every text is scored as a whole, in the partition where it lies.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import held_out

SIZES = (3, 4, 5, 6)  # bytes of an n-gram
BITS = 20
SAMPLE_ROWS = 2_000  # labelled rows of each class that are learnt from
SAMPLE_CHARS = 20_000  # longer texts are scored, but not learnt from
TELLING = 50_000  # n-grams that get a weight: those that tell the classes apart best
BLOCK = 1 << 18  # n-grams of texts that the fit works on together
SMOOTHING, PENALTY, STEPS = 1.0, 0.00005, 200

_SMALL = np.arange(256, dtype=np.uint32)
_SMALL[65:91] += 32
_SMALL[9:14] = 32


class Model(NamedTuple):
    """A weight for every hashed n-gram, and the score's offset."""

    weights: np.ndarray
    offset: float


def _grams(text: str | None) -> Iterator[np.ndarray]:
    """Hashed n-grams of each size, of small letters between spaces."""
    raw = np.frombuffer(f" {text or ''} ".encode("utf-8"), dtype=np.uint8)
    letters = _SMALL[raw]
    run = np.zeros(len(letters), dtype=np.uint32)
    for size in range(1, max(SIZES) + 1):
        if size > len(letters):
            return
        run = run[: len(letters) - size + 1] * np.uint32(0x01000193) + letters[size - 1 :] + np.uint32(1)
        if size in SIZES:
            mixed = run * np.uint32(0x9E3779B1)
            yield ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)


def features(text: str | None) -> np.ndarray:
    parts = list(_grams(text))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


def fit(texts: list[str | None], labels: list[int]) -> Model:
    """Weights from labelled texts; without examples of both classes all scores are the share of toxic."""
    y = np.array(labels, dtype=float)
    size = 1 << BITS
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    # N-grams are taken from the texts twice, one text at a time: all of them side by side would fill the driver.
    counts = np.zeros((2, size), dtype=np.int32)
    for text, label in zip(texts, labels):
        counts[1 if label else 0][features(text)] += 1
    # An n-gram of fewer than three texts tells nothing about others.
    often = np.flatnonzero(counts.sum(axis=0) >= 3)
    other, toxic = counts[:, often] + SMOOTHING
    ratio = np.log(toxic / (y.sum() + 2 * SMOOTHING)) - np.log(other / (len(y) - y.sum() + 2 * SMOOTHING))
    tells = np.abs(ratio) * np.sqrt(toxic + other)
    tells = tells > (np.partition(tells, -TELLING)[-TELLING] if len(tells) >= TELLING else 0)
    used, ratio = often[tells], ratio[tells]
    del counts, often, other, toxic, tells
    blocks, lengths = _blocks(texts, used)
    return _regression(blocks, lengths, ratio / np.sqrt(lengths.clip(1).mean()), used, y, share)


def _blocks(texts: list[str | None], used: np.ndarray) -> tuple[list[tuple[int, int, np.ndarray]], np.ndarray]:
    """Neighbouring texts as (begin, end, the places in `used` of all their n-grams), about BLOCK places
    in a block; and how many each text has."""
    place = np.full(1 << BITS, len(used), dtype=np.min_scalar_type(len(used)))  # two bytes for up to TELLING
    place[used] = np.arange(len(used))
    out, begin, held, n, lengths = [], 0, [], 0, []
    for i, text in enumerate(texts):
        found = place[features(text)]
        held.append(found[found < len(used)])
        lengths.append(len(held[-1]))
        n += lengths[-1]
        if n >= BLOCK or i + 1 == len(texts):
            out.append((begin, i + 1, np.concatenate(held)))
            begin, held, n = i + 1, [], 0
    return out, np.array(lengths)


def _regression(
    blocks: list[tuple[int, int, np.ndarray]], lengths: np.ndarray, scale: np.ndarray, used: np.ndarray, y: np.ndarray, share: float
) -> Model:
    """Logistic regression by accelerated proximal steps; the penalty shrinks weights to zero.

    Nothing but the blocks is as long as the n-grams of all texts; what is taken from them is taken
    block by block.
    """

    def forward(w: np.ndarray) -> np.ndarray:
        scaled, out = scale * w, np.zeros(len(y))
        for begin, end, places in blocks:
            rows = np.repeat(np.arange(end - begin), lengths[begin:end])
            out[begin:end] = np.bincount(rows, scaled[places], minlength=end - begin)
        return out

    def back(g: np.ndarray) -> np.ndarray:
        out = np.zeros(len(used))
        for begin, end, places in blocks:
            out += np.bincount(places, np.repeat(g[begin:end], lengths[begin:end]), minlength=len(used))
        return scale * out

    probe = np.random.default_rng(3).normal(size=len(used))
    for _ in range(12):
        probe /= np.linalg.norm(probe) or 1.0
        probe = back(forward(probe))
    rate = 4 * len(y) / (1.1 * np.linalg.norm(probe) + len(y) + 1e-9)
    w, v, b, t = np.zeros(len(used)), np.zeros(len(used)), float(np.log(share / (1 - share))), 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-np.clip(forward(v) + b, -40, 40))) - y
        new = v - rate * back(error) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        b -= rate * error.mean()
        following = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / following * (new - w)
        w, t = new, following
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[used] = w * scale
    return Model(weights, b)


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    """Between 0 and 1; each distinct n-gram with a weight counts once."""
    sums = np.full(len(texts), model.offset)
    for i, text in enumerate(texts):
        heavy = [g[model.weights[g] != 0] for g in _grams(text)]
        if heavy:
            sums[i] += model.weights[np.unique(np.concatenate(heavy))].sum(dtype=np.float64)
    return 1 / (1 + np.exp(-np.clip(sums, -40, 40)))


def training_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS,
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most `sample_rows` rows per class, none of them held out.

    The rows are those whose ids have the smallest digests, among the ids that have both a label
    and a text of at most `sample_chars` characters, so the sample depends neither on the order
    of rows nor on labels without a text. An id counts once, with its first text in order and its
    smallest label. Empty tables give no rows.
    """
    known = labels.select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("_label")
    ).filter(F.col("_label").isin(0, 1) & ~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_label").alias("_label"))
    short = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).filter(
        F.length("_text") <= sample_chars
    )
    usable = known.join(short.select("_id"), "_id", "left_semi")
    chosen = [
        usable.filter(F.col("_label") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample_rows) for y in (0, 1)
    ]
    rows = (
        short.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_id")
        .groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
        .select("_id", "_text", "_label").toArrow().sort_by([("_id", "ascending"), ("_text", "ascending")])
    )
    return rows.column("_text").to_pylist(), rows.column("_label").to_pylist()


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; a null text counts as an empty one, repeated rows give a row each."""
    id_type = docs.schema[id_col].dataType.simpleString()
    at = np.flatnonzero(model.weights)
    sparse = (at, model.weights[at], model.offset)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS, dtype=np.float32)
        weights[sparse[0]] = sparse[1]
        own = Model(weights, sparse[2])
        for batch in batches:
            scores = score_texts(batch.column(1).to_pylist(), own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], [id_col, "score"])

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        run, f"`{id_col}` {id_type}, score double"
    )


def drop_toxic(
    docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows with a score under `least`, with all their columns, in whatever types and by whatever names they have.

    A null or empty text has the score of no n-grams at all; texts of any length are scored whole, a
    repeated row stays or goes each time, and an empty table gives none. A model without weights, as one learnt without examples of both classes, tells no text from
    another: all rows stay, with a warning.
    """
    # By position: a name may hold a dot or stand there twice.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    schema = plain.schema
    place = docs.columns.index(text_col)
    at = np.flatnonzero(model.weights)
    if not len(at):
        warnings.warn("the toxicity model has no weights; all documents are kept", stacklevel=2)
        return docs
    sparse = (at, model.weights[at], model.offset)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS, dtype=np.float32)
        weights[sparse[0]] = sparse[1]
        own = Model(weights, sparse[2])
        for batch in batches:
            yield batch.filter(pa.array(score_texts(batch.column(place).to_pylist(), own) < least))

    return plain.mapInArrow(run, schema).toDF(*docs.columns)
