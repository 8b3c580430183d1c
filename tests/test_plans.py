"""The plans of all queries: no nested loops, no row-wise Python, pruned scans."""

from __future__ import annotations

import re

import pytest

from feedlake import schemas
from feedlake.plans import adapters as a
from feedlake.plans import catalog
from feedlake.session import shared_dir
from feedlake.sources import tables
from feedlake.sources.tables import append_table, read_table, upsert_table

# Each is one query per family; their plans hold those of the others.
NAMES = [
    "gold_by_region", "stage_records", "upsert_articles", "mark_embedded", "embed_hashed",
    "vector_metadata", "topk_scoped", "cosine_score", "keyword_score", "route_parse",
    "insight_result", "contract_violations",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loops_and_no_row_wise_python(spark, sf_dir, name):
    text = plan(catalog()[name].run(spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in text


def test_models_run_once_per_row(spark, sf_dir):
    assert plan(catalog()["embed_hashed"].run(spark, sf_dir)).count("ArrowEvalPython") == 1


def test_text_is_cleaned_once(spark, sf_dir):
    text = plan(a.silver(spark, sf_dir).select("content"))
    filters = re.findall(r"Filter .*", text)
    assert not any("regexp_replace" in f for f in filters)


def test_scans_read_only_what_is_asked_for(spark, sf_dir):
    text = plan(a.articles(spark, sf_dir).select("article_id", "region"))
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text


def test_dates_prune_partitions(spark, sf_dir):
    path = shared_dir(spark, "gold")
    append_table(a.gold(spark, sf_dir), path, schemas.GOLD_PARTITIONS)
    text = plan(read_table(spark, path, schemas.GOLD, "2025-01-02").select("chunk_id"))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert "ingestion_date" in filters and "2025-01-02" in filters or "20090" in filters
    assert "ReadSchema: struct<chunk_id:string>" in text


def test_rewrites_prune_to_touched_partitions(spark, sf_dir, monkeypatch):
    """The plan that an upsert makes opens the touched partitions and no other."""
    path = shared_dir(spark, "gold")
    append_table(a.gold(spark, sf_dir), path, schemas.GOLD_PARTITIONS)
    table = read_table(spark, path, schemas.GOLD)
    one = table.filter("region = 'emea' AND ingestion_date = DATE '2025-01-02'").limit(3)
    plans = {}
    real = tables.materialize

    def spy(df, label):
        plans.setdefault(label, plan(df))
        return real(df, label)

    monkeypatch.setattr(tables, "materialize", spy)
    upsert_table(spark, path, one, ["chunk_id", "ingestion_date"], schemas.GOLD_PARTITIONS)
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plans["rewrite"]).group(1)
    assert "region" in filters and "= 2025-01-02" in filters
    # The search for the keys is limited to the date, which is part of the key.
    found = re.findall(r"PartitionFilters: \[([^\]]*)\]", plans["touched"])
    assert any("= 2025-01-02" in f for f in found)
