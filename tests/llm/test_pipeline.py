"""The pipeline: what each stage keeps, and awkward tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from feedlake.llm.queries import QUERIES
from feedlake.session import shared_dir
from tests.llm.cases import DOC_SCHEMA, DOCS
from tests.oracle import connect, difference


def test_queries_are_registered():
    names = [n for n in queries() if n.startswith("op") or n == "pipeline"]
    assert sorted({n.split("_")[0] for n in names}) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
    assert set(oracle_sql()) >= {"op1_url_filter", "op8_rule_cascade", "op10_near_copies"}


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_matches_sql(spark, sf_dir, name):
    frame = QUERIES[name].run(spark, sf_dir).toPandas()
    assert len(frame) and difference(frame, connect(sf_dir).execute(QUERIES[name].sql).df()) is None


def test_stages(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, now = docs.columns, docs
    ids = [sorted(r[0] for r in docs.select("doc_id").collect())]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = shared_dir(spark, "stage")
        stage(spark, now, sf_dir).write.parquet(path)
        now = spark.read.parquet(path)
        assert now.columns == columns
        ids.append(sorted(r[0] for r in now.select("doc_id").collect()))
        assert set(ids[-1]) <= set(ids[-2])
    assert len(ids[0]) > len(ids[1]) > len(ids[2]) >= len(ids[3]) == len(ids[4]) > 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = {r[0] for r in labels.filter("quality = 1 AND toxic = 0").select("doc_id").collect()}
    long = {r[0] for r in docs.filter(F.size(F.split("text", r"\s+")) >= 60).select("doc_id").collect()}
    assert len(clean & long & set(ids[1])) >= 0.99 * len(clean & long)
    assert len(clean & set(ids[2])) >= 0.99 * len(clean & set(ids[1]))
    assert now.filter(F.length("text") != F.col("n_chars")).count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).orderBy("sequence_id", "offset").collect()
    text = {r["doc_id"]: r["text"] for r in now.collect()}
    library = Tokenizer.from_str(tokenizer)
    got = {}
    for r in pieces:
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in text.items()}


@pytest.mark.parametrize("rows", [DOCS, []])
def test_awkward_tables(spark, rows):
    d = shared_dir(spark, "tables")
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (1, 1, 1), (None, 1, 1), (2, None, None)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    out = corpus_pipeline.run(spark, d)
    held = {r["doc_id"] for r in out.collect()}
    assert held <= {r[0] for r in DOCS} and bool(held) == bool(rows)
    now = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, now, d).columns == now.columns


@pytest.mark.parametrize("labels", [[], [(0, 1, 1), (1, 1, 1)]])
def test_without_examples_of_both_classes_no_document_is_dropped(spark, docs, labels):
    d = shared_dir(spark, "tables")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    with pytest.warns(UserWarning, match="no weights"):
        out = corpus_pipeline.toxic_texts(spark, docs, d)
    assert out.columns == docs.columns and out.count() == len(DOCS)
