"""Toxicity and quality: accuracy on rows kept from training, and the chain's sums."""

from __future__ import annotations

import itertools
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import quality, toxicity
from feedlake.llm.common import held_out
from tests.llm.cases import DOCS

DATA = "/root/testdata/sf0.1"


def auc(y, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    _, place, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[place]
    assert len(order) == len(y)
    good = y.sum()
    return (rank[y == 1].sum() - good * (good + 1) / 2) / (good * (len(y) - good))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def checked(scores, labels, column, least, from_score):
    rows = scores.join(labels, "doc_id").filter(held_out(F.col("doc_id"))).select("score", column).toPandas()
    y = rows[column].to_numpy()
    assert rows["score"].between(0, 1).all() and len(y) > 500
    assert auc(y, rows["score"].to_numpy()) >= least
    assert ((rows["score"] >= from_score) == y).mean() >= 0.96


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    model = toxicity.fit(*toxicity.training_sample(docs, labels, "toxic"))
    checked(toxicity.score_toxicity(docs, model), labels, "toxic", 0.97, 0.5)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema and 0 < docs.count() - kept.count() < 0.3 * docs.count()


def test_the_fit_holds_few_bytes_an_ngram():
    rng = np.random.default_rng(1)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words, 1500)) for _ in range(400)]  # of 13 million distinct n-grams
    tracemalloc.start()
    model = toxicity.fit(texts, [i % 2 for i in range(400)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20 and model.weights.any()


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    sample = toxicity.training_sample(docs, labels, "quality", sample_rows=quality.SAMPLE_ROWS)
    checked(quality.score_quality(docs, quality.fit(*sample)), labels, "quality", 0.98, 0.3)


def test_sample_holds_no_held_out_row(spark, tables):
    docs, labels = tables
    odd = labels.withColumn("toxic", F.lit(1)).filter("doc_id < 500")
    texts, y = toxicity.training_sample(docs, odd, "toxic", sample_rows=40)
    ids = {r["text"]: r["doc_id"] for r in docs.filter("doc_id < 500").collect()}
    assert len(texts) <= 40 and set(y) == {1}
    twice = toxicity.training_sample(docs.repartition(7), odd.repartition(3), "toxic", sample_rows=40)
    assert twice == (texts, y)
    learnt = [r[0] for r in docs.join(odd, "doc_id").filter(~held_out(F.col("doc_id"))).select("text").collect()]
    assert set(texts) <= set(learnt) and ids


def test_held_out_is_the_digest_of_the_id(spark):
    df = spark.createDataFrame([(i,) for i in range(200)] + [(None,)], "doc_id long")
    for r in df.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        assert r["h"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


@pytest.mark.parametrize("labels", [[], [1, 1], [0, 0, 0]])
def test_training_without_both_classes(spark, docs, none, labels):
    texts = ["some words here\nand a line"] * len(labels)
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    tox, good = toxicity.fit(texts, labels), quality.fit(texts, labels)
    for scores in (toxicity.score_toxicity(docs, tox), quality.score_quality(docs, good)):
        rows = scores.collect()
        assert len(rows) == len(DOCS)
        assert all(abs(r["score"] - share) < 1e-6 for r in rows)
    assert toxicity.score_toxicity(none, tox).count() == quality.score_quality(none, good).count() == 0


def test_awkward_documents(docs):
    tox = toxicity.fit(["you idiot here", "a kind word", None, ""] * 5, [1, 0, 0, 0] * 5)
    good = quality.fit(["good line of text\nand more of it", "$$$ *** %%%\n### @@@", None, ""] * 5, [1, 0, 1, 0] * 5)
    for scores in (toxicity.score_toxicity(docs, tox), quality.score_quality(docs, good)):
        rows = scores.collect()
        assert sorted((r["doc_id"] for r in rows), key=str) == sorted((r[0] for r in DOCS), key=str)
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_chain_sums_against_all_labellings():
    rng = np.random.default_rng(3)
    counts = np.array([3, 0, 1, 5, 2])
    unary, steps = rng.normal(size=counts.sum()), rng.normal(size=(2, 2))
    good, expected = quality.marginals(unary, steps, counts)
    at, wanted, pairs = 0, [], np.zeros((2, 2))
    for n in counts[counts > 0]:
        u = unary[at:at + n]
        at += n
        weight = {}
        for y in itertools.product((0, 1), repeat=int(n)):
            weight[y] = np.exp(sum(u[i] for i in range(n) if y[i]) + sum(steps[a, b] for a, b in itertools.pairwise(y)))
        total = sum(weight.values())
        wanted += [sum(w for y, w in weight.items() if y[i]) / total for i in range(n)]
        for y, w in weight.items():
            for a, b in itertools.pairwise(y):
                pairs[a, b] += w / total
    assert np.allclose(good, wanted) and np.allclose(expected, pairs)


def test_line_features_of_batches_and_single_texts():
    texts = [r[1] for r in DOCS]
    together = quality.lines_of(texts)
    alone = [quality.lines_of([t]) for t in texts]
    assert np.allclose(together.features, np.concatenate([x.features for x in alone]))
    assert together.counts.tolist() == [int(x.counts[0]) for x in alone]
