"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from feedlake.llm import ann


def brute(rows, queries, k):
    out = {}
    for qid, q in queries:
        ranked = sorted(
            {(float(np.sqrt(((np.array(v, float) - np.array(q, float)) ** 2).sum())), i) for i, v in rows if i != qid}
        )
        best = {}
        for d, i in ranked:
            best.setdefault(i, d)
        out[qid] = sorted((d, i) for i, d in best.items())[:k]
    return out


def result(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [(d, i) for _, d, i in sorted(v)] for q, v in out.items()}


SCHEMA = "vec_id long, embedding array<float>, id string, v int, d double, query_id long"


def test_recall_on_given_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    queries = [r for r in rows if r[0] % 20 == 0]
    found = result(ann.nearest(table, table.filter("vec_id % 20 = 0")))
    wanted = brute(rows, queries, 10)
    hits = sum(len({i for _, i in wanted[q]} & {i for _, i in found[q]}) for q in wanted)
    assert hits >= 0.95 * sum(map(len, wanted.values()))
    assert all([i for _, i in v] and sorted(v) == v for v in found.values())


@pytest.mark.parametrize("block", [4096, 2])
def test_awkward_vectors(spark, block):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), 1.0, float(i // 3)]) for i in range(12)]
    rows = good + [
        (0, good[0][1]), (5, good[5][1]),  # repeated rows
        (30, None), (31, [0.0, 0.0, 0.0]), (32, [nan, 1.0, 1.0]), (33, [inf, 0.0, 0.0]), (34, [1.0, 2.0]),
        (35, []), (None, [1.0, 1.0, 1.0]), (36, good[3][1]),  # ties go to the smaller id
    ]
    df = spark.createDataFrame([(i, v, "x", 1, 0.5, 9) for i, v in rows], SCHEMA).repartition(3)
    usable = good + [(36, good[3][1])]
    found = result(ann.nearest(df, df.filter("vec_id % 3 = 0 OR vec_id IS NULL"), query_block=block))
    queries = [r for r in usable if r[0] % 3 == 0]
    wanted = brute(usable, queries, 10)
    assert {q: [i for _, i in v] for q, v in found.items()} == {q: [i for _, i in v] for q, v in wanted.items()}
    assert all(abs(a - b) < 1e-12 for q in wanted for (a, _), (b, _) in zip(found[q], wanted[q]))


def test_fewer_candidates_than_wanted(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 2.0]) for i in range(4)], "vec_id long, embedding array<float>")
    found = result(ann.nearest(df, df.filter("vec_id = 0")))
    assert [i for _, i in found[0]] == [1, 2, 3]
    one = df.filter("vec_id = 0")
    assert ann.nearest(one, one).count() == 0
    assert ann.nearest(df.filter("false"), df).count() == 0
    assert ann.nearest(df, df.filter("false")).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, size=(500, 4), dtype=np.uint8)
    index = ann.Substrings(codes)
    for radius in (0, 3, 7, 11, 20, 32):
        for code in codes[:20]:
            bits = np.bitwise_count(codes ^ code).sum(axis=1)
            assert index.within(code, radius).tolist() == np.flatnonzero(bits <= radius).tolist()


def test_a_radius_that_finds_too_few_is_widened(spark, monkeypatch):
    monkeypatch.setattr(ann, "learn", lambda sample, k, learn=ann.learn: learn(sample, k)._replace(radius=0))
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = result(ann.nearest(df, df.filter("vec_id < 5")))
    wanted = brute(rows, rows[:5], 10)
    assert {q: [i for _, i in v] for q, v in found.items()} == {q: [i for _, i in v] for q, v in wanted.items()}
