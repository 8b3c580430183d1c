"""What jobs leave on disk, and the ways of large tables on small ones."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from feedlake import schemas, session
from feedlake.operators import upsert
from feedlake.operators.bronze import dedup_bronze
from feedlake.operators.medallion import load_records, run_medallion
from feedlake.session import materialize, shared_dir
from feedlake.sources import tables
from feedlake.sources.staging import write_staging
from feedlake.sources.tables import read_table, replace_rows, upsert_table


@pytest.fixture
def large(monkeypatch):
    monkeypatch.setattr(upsert, "WHOLE_BYTES", -1)
    monkeypatch.setattr(tables, "PART_BYTES", 1)


@pytest.fixture
def made(monkeypatch):
    """Folders that were made for intermediates."""
    paths, real = [], shared_dir
    monkeypatch.setattr(session, "shared_dir", lambda spark, label: paths.append(real(spark, label)) or paths[-1])
    return paths


def _bytes(folders):
    return sum(os.path.getsize(os.path.join(d, f)) for top in folders for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet"))


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark):
    before = _shuffles(spark)
    df = spark.range(1000).repartition(4, "id")
    out = materialize(df, "x")
    assert out.count() == 1000
    after = {n.split("_")[1] for n in _shuffles(spark) - before}
    # Those of the count are there; the write's had four map outputs before.
    assert len(after) <= 1


def _articles(spark, rows):
    text = "Number {} of all the articles that are there, each with a text of its own. "
    return spark.createDataFrame(
        [(f"a{i}", "f", ("emea", "global")[i % 2], "rss", "u", f"t{hour}", None, text.format(n) * 40, None, "en", "{}",
          dt.datetime(2025, 1, 1, hour), dt.date(2025, 1, 1 + i % 3)) for i, n, hour in rows], schemas.BRONZE)


def _lake(spark, root):
    return {
        name: sorted(map(str, read_table(spark, f"{root}/{name}", schema).drop("processed_at", "created_at").collect()))
        for name, schema in (("bronze", schemas.BRONZE), ("silver", schemas.SILVER), ("gold", schemas.GOLD))
    }


def test_large_jobs_give_the_same_tables_and_keep_no_texts(spark, monkeypatch, made):
    hours = [
        [(i, i, 1) for i in range(30)] + [(3, 100, 2)],  # an article twice
        [(i, i, 3) for i in range(30, 40)],  # only new ones
        [(5, 200, 4), (6, 7, 5), (31, 300, 2)],  # another text, a copy's text, an older record
    ]
    roots = {}
    for way in ("small", "large"):
        if way == "large":
            monkeypatch.setattr(upsert, "WHOLE_BYTES", -1)
            monkeypatch.setattr(tables, "PART_BYTES", 1)
        root = roots[way] = shared_dir(spark, way)
        for h, rows in enumerate(hours):
            staged = _articles(spark, rows).withColumns({
                c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'") for c in ("published_at", "ingested_at")
            })
            folder = write_staging(staged.select(*schemas.STAGING.fieldNames()), f"{root}/staging", "2025-01-01", f"{h}")
            made.clear()
            counts = run_medallion(spark, folder, root)
            assert counts["bronze"] == len({i for i, _, _ in rows})
            # Bronze, silver, gold, cleaned texts and rewrites lay there before.
            assert _bytes(p for p in made if any(n in p for n in ("/bronze-", "/cleaned-", "/records_", "/rewrite-", "/source-"))) == 0
    assert _lake(spark, roots["small"]) == _lake(spark, roots["large"])
    whole = shared_dir(spark, "whole")
    load_records(spark, dedup_bronze(_articles(spark, sum(hours, []))), whole)
    assert _lake(spark, whole) == _lake(spark, roots["large"])


def test_large_tables_change_like_small_ones(spark, large):
    def frame(rows):
        return spark.createDataFrame(rows, "k string, v int, p string, q string")

    def rows():
        return sorted(map(tuple, read_table(spark, path).select("k", "v", "p", "q").collect()), key=str)

    path = shared_dir(spark, "t")
    order = [F.col("v").desc(), F.col("p"), F.col("q")]
    upsert_table(spark, path, frame([("a", 1, "x", "u1"), ("a", 3, "x", "u2"), (None, 1, None, "u1")]), ["k", "p"], ["p", "q"], order, newest=True)
    assert rows() == sorted([("a", 3, "x", "u2"), (None, 1, None, "u1")], key=str)
    upsert_table(spark, path, frame([("b", 1, "x", "u1"), ("c", 1, "y", "u1")]), ["k", "p"], ["p", "q"], order, newest=True)
    upsert_table(spark, path, frame([("a", 2, "x", "u1"), (None, 5, None, "u3"), ("b", 4, "x", "u9")]), ["k", "p"], ["p", "q"], order, newest=True)
    now = [("a", 3, "x", "u2"), (None, 5, None, "u3"), ("b", 4, "x", "u9"), ("c", 1, "y", "u1")]
    assert rows() == sorted(now, key=str)
    upsert_table(spark, path, frame([("a", 0, "x", "u1"), ("d", 0, "z", "u1")]), ["k", "p"], ["p", "q"])
    now = [("a", 0, "x", "u1"), ("d", 0, "z", "u1"), *now[1:]]
    assert rows() == sorted(now, key=str)
    schema = read_table(spark, path).select("k", "v", "p", "q").schema
    replace_rows(spark, path, schema, frame([("a", 0, "x", "u1"), ("none", 0, "y", "u1")]), frame([("e", 1, "z", "u1")]), ["k"], ["p", "q"])
    assert rows() == sorted([("e", 1, "z", "u1"), *now[1:]], key=str)


def test_many_queries_do_not_shuffle_the_corpus(spark, monkeypatch):
    from feedlake.operators import retrieve, topk

    monkeypatch.setattr(topk, "SPREAD_BYTES", -1)
    monkeypatch.setattr(topk, "CELL_ROWS", 7)
    words = ["supply", "chain", "risks", "regions", "forecast"]
    texts = [(i, i % 3, " ".join(w for j, w in enumerate(words) if i >> j & 1)) for i in range(40)]
    asked = [(f"q{i}", " ".join(words[: i % 6])) for i in range(30)]
    chunks = spark.createDataFrame(texts, "ordinal long, chunk_index int, chunk_text string")
    queries = spark.createDataFrame(asked, "query_id string, query string")
    found = retrieve.top_k_keywords(chunks.repartition(3), queries, ["ordinal", "chunk_index"], 4, 2)
    # Cells of the corpus were dealt out by _task before, copied for each block.
    assert "_task" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["ordinal"], r["score"]))
    for q, query in asked:
        scores = [(sum(w in t for w in query.split()), i) for i, _, t in texts]
        best = sorted(scores, key=lambda s: (-s[0], s[1]))[:4]
        assert got[q] == [(i, s) for s, i in best if s or not best[0][0]]


def test_state_of_newest_records_holds_no_texts(spark):
    """The state held whole records before, texts included."""
    from feedlake.streaming.incremental import newest_times, of_newest_times, with_newest_times

    rows = _articles(spark, [(1, 1, 1), (1, 2, 3), (1, 3, 3), (2, 4, 2)])
    assert {f.name for f in newest_times(rows).schema} == {"article_id", "ingestion_date", "_at"}
    kept = of_newest_times(materialize(with_newest_times(rows), "batch"))
    assert sorted((r["article_id"], r["body"][:8]) for r in kept.collect()) == [
        ("a1", "Number 2"), ("a1", "Number 3"), ("a2", "Number 4")]
