"""Near copies against all pairs."""

from __future__ import annotations

import itertools
import pathlib
import random
import re

import numpy as np
import pytest

from feedlake import session
from feedlake.llm import neardup
from feedlake.llm.components import components, merged
from tests.llm.cases import DOC_SCHEMA, DOCS, prose


def shingles(text, k):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", lowered)
    if len(w) >= k:
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows, k, percent=80):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    out = [(i, len(s), root(i), root(i) == i) for i, s in sets]
    return sorted(out + [(None, None, None, True) for i, _ in rows if i is None], key=str)


def edited(text, n, seed):
    rnd, words = random.Random(seed), text.split(" ")
    for i in rnd.sample(range(len(words)), n):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


def family(start, size, words, most):
    text = prose(start, words)
    return [(start + i, edited(text, i * most // size, start + i)) for i in range(size)]


@pytest.mark.parametrize("words", [2, 5])
def test_awkward_documents(spark, docs, words):
    got = sorted(map(tuple, neardup.near_duplicates(docs, words=words).collect()), key=str)
    assert got == brute([(r[0], r[1]) for r in DOCS], words)


def test_families_of_copies(spark):
    rows = family(1000, 150, 120, 14) + family(2000, 40, 60, 5) + family(3000, 12, 400, 60)
    rows += [(i, prose(i, 80)) for i in range(4000, 4060)]
    rows += [(i, prose(5000, 90)) for i in range(5000, 5100)]  # exact copies
    rows += [(6000 + i, prose(6000, 60) + " " + prose(6001 + i, 60)) for i in range(60)]  # a shared passage
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for words in (2, 5):
        got = sorted(map(tuple, neardup.near_duplicates(df, words=words).collect()), key=str)
        assert got == brute(rows, words)


def test_large_nodes_branch_on(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PAIRS_PER_MEMBER", 1)
    rows = family(1000, 60, 100, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, neardup.near_duplicates(df, words=2).collect()), key=str)
    assert got == brute(rows, 2)


def test_only_nodes_of_several_classes_are_searched(spark, monkeypatch):
    rows = family(1000, 6, 100, 6) + [(i, prose(i, 80)) for i in range(4000, 4100)]
    seen = []

    def noted(df, label):
        out = materialize(df, label)
        if label in ("near_members", "near_sets"):
            seen.append((label, out))
        return out

    materialize = neardup.materialize
    monkeypatch.setattr(neardup, "materialize", noted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, neardup.near_duplicates(df, words=2).collect()), key=str)
    assert got == brute(rows, 2)
    members = [m for label, m in seen if label == "near_members"]
    assert members and all(m.groupBy("node").count().filter("count = 1").isEmpty() for m in members)
    assert "near_sets" not in dict(seen)  # no id repeats, so no set is shuffled to find repeated ones


@pytest.mark.parametrize("levels", [3, 7, 15, 21])
def test_recall_does_not_fall_with_depth(levels):
    """Pairs at the threshold share a node at any depth, in as many trees as are asked for there."""
    pairs, rng = 2000, np.random.default_rng(levels)
    a = rng.integers(1 << 16, size=(pairs, neardup.TOKENS)).astype(np.uint16)
    agree = rng.random(a.shape) < 0.8
    agree[agree.mean(axis=1) < 0.8 - neardup.MARGIN] = True  # these the estimate drops
    b = np.where(agree, a, a ^ 1)
    found = np.zeros(pairs, bool)
    for tree in range(neardup.trees_for(levels, 80)):
        left = np.flatnonzero(~found)
        sides = []
        for tokens in (a, b):
            pair, key = left, neardup._mixed(np.full(len(left), tree + 1, np.uint64))
            for _ in range(levels):
                row, key = neardup._branch(key, tokens[pair], 1.25)
                pair = pair[row]
            sides.append(neardup._mixed(key) ^ neardup._mixed(pair.astype(np.uint64) + np.uint64(1)))
        found[pair[np.isin(sides[1], sides[0])]] = True
    assert found.sum() >= pairs - 1


def test_one_of_each_group_stays(spark, docs):
    out = neardup.drop_near_duplicates(docs, words=2)
    assert out.schema == docs.schema
    rows = out.collect()
    ids = sorted(str(r["doc_id"]) for r in rows)
    keep = {i for i, _, root, kept in brute([(r[0], r[1]) for r in DOCS], 2) if kept and i is not None}
    assert ids == sorted([str(i) for i in keep] + ["None", "None"])


def test_empty_table(none):
    assert neardup.near_duplicates(none).count() == 0
    assert neardup.drop_near_duplicates(none).count() == 0


def test_sets_and_sketches():
    texts = ["a b c a b", "A\tB", "a", "", None, "é ü", "a b" * 3, " lead trail "]
    for k in (1, 2, 3, 5):
        got = neardup.shingle_sets(texts, k)
        assert [len(s) for s in got] == [len(shingles(t, k)) for t in texts]
        assert all((np.diff(s.astype(object)) > 0).all() for s in got)
    same = neardup.shingle_sets(["x y z", "q x Y z"], 2)
    assert len(np.intersect1d(*same)) == 2
    base = [prose(1, 300), edited(prose(1, 300), 20, 1)]
    sets = neardup.shingle_sets(base, 2)
    a, b = neardup.sketches(sets)
    exact = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert abs((a == b).mean() - exact) < 0.1


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(100, 160)]
    edges += [(rnd.randint(300, 400), rnd.randint(300, 400)) for _ in range(70)] + [(7, 7)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["u"]: r["v"] for r in components(df).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in list(parent) if root(x) != x}
    assert components(df.filter("false")).count() == 0
    half = components(df.filter("u % 2 = 0"))
    again = {r["u"]: r["v"] for r in merged(half, df.filter("u % 2 = 1")).collect()}
    assert again == got


def test_a_third_of_all_rows_are_one_text(spark):
    rows = [(i, prose(1, 100) if i % 3 == 0 else prose(i, 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(df).collect()
    assert {r["component_id"] for r in got if r["doc_id"] % 3 == 0} == {0}
    assert sum(r["kept"] for r in got) == 201


def test_schema_of_cases():
    assert len(DOCS[0]) == DOC_SCHEMA.count(",") + 1


@pytest.mark.parametrize("cluster", [4096, 3])
def test_templates_just_under_and_over_the_threshold(spark, monkeypatch, cluster):
    """Families around one template, most pairs of which lie just under the threshold; in clusters, and in nodes."""
    monkeypatch.setattr(neardup, "CLUSTER", cluster)
    monkeypatch.setattr(neardup, "PASSING", 16)
    rows = []
    for f in range(3):
        base = prose(7000 + f, 150)
        rows += [(7000 + 200 * f + i, edited(base, 4 + i % 9, 7000 + 200 * f + i)) for i in range(110)]
    rows += [(i, prose(i, 150)) for i in range(9000, 9080)]
    random.Random(6).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows, 2)
    assert len({r[2] for r in want if r[0] < 9000}) > 20
    assert sorted(map(tuple, neardup.near_duplicates(df, words=2).collect()), key=str) == want


def test_only_the_result_stays_on_disk(spark, docs, monkeypatch):
    before, made, real = session.materialize(docs, "given"), [], session.shared_dir
    monkeypatch.setattr(session, "shared_dir", lambda s, label: made.append(real(s, label)) or made[-1])
    found, kept = neardup.near_duplicates(before, 2), neardup.drop_near_duplicates(before, 2)
    there = [p for p in made if pathlib.Path(p.removeprefix("file:")).exists()]
    assert len(made) > 10 and [p.rsplit("/", 1)[1].split("-")[0] for p in there] == ["near_found"] * 2
    assert found.count() == before.count() == len(DOCS) and kept.count()
