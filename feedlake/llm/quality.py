"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. Its features describe its own
characters and words, and those of its neighbours; neighbouring labels depend on each
other. Forward and backward sums give each line's probability of being good, and a
document's score is their mean, weighted by the lines' lengths. A line of a labelled
document is taught that document's label.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 2_000  # labelled rows of each class that are learnt from
SAMPLE_CHARS = 20_000  # longer texts are scored, but not learnt from
WINDOW = 64  # lines of a chain in training; longer documents are several chains
STEPS, RATE, PENALTY = 150, 0.1, 1e-4
SLICE_CHARS = 1 << 20

_WORD_BREAK = np.zeros(256, dtype=bool)
_WORD_BREAK[[9, 10, 11, 12, 13, 32]] = True
_KINDS = np.zeros((7, 256), dtype=bool)  # small, capital, digit, symbol, mark, end of sentence, bar
_KINDS[0, 97:123] = True
_KINDS[1, 65:91] = True
_KINDS[2, 48:58] = True
for _k, _set in ((3, b"#*$%&<>@^~=+_\\{}[]"), (4, b",;:'\"()-"), (5, b".!?"), (6, b"|!")):
    _KINDS[_k, list(_set)] = True
N_OWN = 14


class Lines(NamedTuple):
    features: np.ndarray  # a row per line with a word
    lengths: np.ndarray  # its characters' bytes
    counts: np.ndarray  # lines of each text


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # of the features, for good against bad
    steps: np.ndarray  # of neighbouring labels, from and to
    prior: float  # score of a text without words


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def _seen_before(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Which places hold a value that their owner has had before."""
    order = np.lexsort((np.arange(len(owner)), value, owner))
    o, v = owner[order], value[order]
    again = np.zeros(len(owner), dtype=bool)
    again[order[1:]] = (o[1:] == o[:-1]) & (v[1:] == v[:-1])
    return again


def lines_of(texts: list[str | None]) -> Lines:
    """Lines with a word of all texts, described by shares of their characters and words."""
    encoded = [(t or "").encode("utf-8") + b"\n" for t in texts]
    raw = np.frombuffer(b"".join(encoded), dtype=np.uint8)
    text_end = np.cumsum([len(e) for e in encoded])
    blank = _WORD_BREAK[raw]
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    line_end = np.flatnonzero(raw == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    first, last = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
    full = last > first
    line_start, line_end, first, last = line_start[full], line_end[full], first[full], last[full]
    owner = np.searchsorted(text_end, line_start, "right")
    counts = np.bincount(owner, minlength=len(texts))
    if not len(owner):
        return Lines(np.zeros((0, 3 * N_OWN)), np.zeros(0), counts)
    length = (line_end - line_start).astype(float)
    n = (last - first).astype(float)

    def per_byte(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[line_end] - sums[line_start]).astype(float)

    def per_word(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return (sums[last] - sums[first]).astype(float)

    letters, capitals, digits, symbols, marks, stops, bars = (per_byte(k[raw]) for k in _KINDS)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(raw.astype(np.uint64) + np.uint64(1)) * np.uint64(3))])
    size = ends - starts
    # The first and last bytes with a sum over the word tell nearly all words apart.
    word = _mixed(
        (sums[ends] - sums[starts]) * np.uint64(31) + raw[starts].astype(np.uint64) * np.uint64(1 << 40)
        + raw[ends - 1].astype(np.uint64) * np.uint64(1 << 50) + size.astype(np.uint64)
    )
    word_owner = np.searchsorted(text_end, starts, "right")
    run = word.copy()
    run[:-1] += word[1:] * np.uint64(5)
    run[:-2] += word[2:] * np.uint64(7)
    again = _seen_before(word_owner, _mixed(run))
    line_hash = np.add.reduceat(word * (np.arange(len(word), dtype=np.uint64) - np.repeat(first, last - first).astype(np.uint64) + np.uint64(1)), first)
    copied = _seen_before(owner, line_hash)
    own = np.stack(
        [
            np.log1p(length), np.log1p(n), symbols / n, bars / n, capitals / (letters + capitals + 1),
            (capitals > letters).astype(float), digits / length, marks / n, stops / n,
            per_byte(raw > 127) / length, per_word(size) / n, per_word(size < 2) / n,
            per_word(again) / n, copied.astype(float),
        ],
        axis=1,
    )
    before, after = np.zeros_like(own), np.zeros_like(own)
    linked = owner[1:] == owner[:-1]
    before[1:][linked] = own[:-1][linked]
    after[:-1][linked] = own[1:][linked]
    return Lines(np.concatenate([own, before, after], axis=1), length, counts)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=-1)
    return top + np.log(np.exp(x - top[..., None]).sum(axis=-1))


def marginals(unary: np.ndarray, steps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each line's probability of being good, and the expected number of each step.

    Chains are laid side by side, the longest first, so that at every place those that
    reach it are the first rows of a matrix.
    """
    counts = counts[counts > 0]
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    order = np.argsort(-counts, kind="stable")
    begin, counts = begin[order], counts[order]
    alive = np.searchsorted(-counts, -np.arange(1, counts.max(initial=0) + 1), "right")
    forward = np.zeros((len(unary), 2))
    backward = np.zeros((len(unary), 2))
    own = np.stack([np.zeros(len(unary)), unary], axis=1)
    for t, m in enumerate(alive):
        at = begin[:m] + t
        forward[at] = own[at]
        if t:
            forward[at] += _log_sum(forward[at - 1][:, None, :] + steps.T[None])
    for t in range(len(alive) - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        backward[at] = _log_sum((own[at + 1] + backward[at + 1])[:, None, :] + steps[None])
    both = forward + backward
    good = np.exp(both[:, 1] - _log_sum(both))
    inner = np.ones(len(unary), dtype=bool)
    inner[begin] = False
    to = np.flatnonzero(inner)
    pair = forward[to - 1][:, :, None] + steps[None] + (own[to] + backward[to])[:, None, :]
    pair = np.exp(pair - _log_sum(both)[to][:, None, None])
    return good, pair.sum(axis=0)


def fit(texts: list[str | None], labels: list[int]) -> Model:
    """Weights by gradient ascent on the chains' likelihood; lines in windows of a chain.

    Without examples of both classes every score is the share of good texts.
    """
    y = np.array(labels, dtype=float)
    prior = float((y.sum() + 0.5) / (len(y) + 1))
    lines = lines_of(texts)
    width = 3 * N_OWN
    if not 0 < y.sum() < len(y) or not len(lines.features):
        weights = np.zeros(width + 1)
        weights[-1] = np.log(prior / (1 - prior))
        return Model(np.zeros(width), np.ones(width), weights, np.zeros((2, 2)), prior)
    truth = np.repeat(y, lines.counts)
    chains = np.concatenate([[WINDOW] * (c // WINDOW) + [c % WINDOW] for c in lines.counts]).astype(int)
    chains = chains[chains > 0]
    mean, spread = lines.features.mean(axis=0), lines.features.std(axis=0) + 1e-6
    x = np.concatenate([(lines.features - mean) / spread, np.ones((len(truth), 1))], axis=1)
    inner = np.ones(len(truth), dtype=bool)
    inner[np.concatenate([[0], np.cumsum(chains)[:-1]])] = False
    to = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[to - 1].astype(int), truth[to].astype(int)), 1)
    theta, m, v = np.zeros(width + 5), np.zeros(width + 5), np.zeros(width + 5)
    for step in range(1, STEPS + 1):
        weights, steps = theta[: width + 1], theta[width + 1 :].reshape(2, 2)
        good, expected = marginals(x @ weights, steps, chains)
        gradient = np.concatenate([x.T @ (truth - good), (seen - expected).ravel()]) / len(truth)
        gradient -= PENALTY * theta
        m = 0.9 * m + 0.1 * gradient
        v = 0.99 * v + 0.01 * gradient**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(mean, spread, theta[: width + 1], theta[width + 1 :].reshape(2, 2), prior)


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    """Between 0 and 1: the mean of the lines' probabilities, by their lengths."""
    lines = lines_of(texts)
    unary = (lines.features - model.mean) / model.spread @ model.weights[:-1] + model.weights[-1]
    good, _ = marginals(unary, model.steps, lines.counts)
    owner = np.repeat(np.arange(len(texts)), lines.counts)
    total = np.bincount(owner, lines.lengths, minlength=len(texts))
    score = np.bincount(owner, lines.lengths * good, minlength=len(texts)) / np.maximum(total, 1)
    return np.clip(np.where(total > 0, score, model.prior), 0, 1)


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; a text without words, empty or null, scores the prior.

    Repeated rows give a row each; other columns are dropped. Nothing is shuffled.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    learnt = tuple(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*learnt)
        for batch in batches:
            texts, begin, size = batch.column(1).to_pylist(), 0, 0
            scores = []
            for i, text in enumerate(texts):
                size += len(text or "")
                if size >= SLICE_CHARS or i + 1 == len(texts):
                    scores.append(score_texts(texts[begin : i + 1], own))
                    begin, size = i + 1, 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                [id_col, "score"],
            )

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        run, f"`{id_col}` {id_type}, score double"
    )
