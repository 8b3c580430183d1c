"""How often texts are written on their way into tables."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators.bronze import KEY, dedup_bronze
from feedlake.session import materialize, shared_dir
from feedlake.sources import tables
from feedlake.sources.staging import read_staging, write_staging
from feedlake.streaming.incremental import newest


def test_new_partitions_are_written_once(spark, monkeypatch):
    labels = []

    def recording(df, label):
        labels.append(label)
        return materialize(df, label)

    monkeypatch.setattr(tables, "materialize", recording)
    path = shared_dir(spark, "t")

    def put(rows):
        labels.clear()
        source = spark.createDataFrame(rows, "k string, p string, v int")
        tables.upsert_table(spark, path, source, ["k"], ["p"])
        return sorted(map(tuple, tables.read_table(spark, path).select("k", "p", "v").collect()))

    assert put([("a", "x", 1), ("b", "x", 1)]) == [("a", "x", 1), ("b", "x", 1)]
    assert "rewrite" not in labels
    assert put([("c", "y", 2)]) == [("a", "x", 1), ("b", "x", 1), ("c", "y", 2)]
    assert "rewrite" not in labels
    assert put([("a", "y", 3)]) == [("a", "y", 3), ("b", "x", 1), ("c", "y", 2)]
    assert "rewrite" in labels


def _bronze(spark):
    day, hour = dt.date(2025, 1, 1), lambda h, us=0: dt.datetime(2025, 1, 1, h, 0, 0, us)
    rows = [
        ("a", "old", hour(1)), ("a", "new", hour(2, 7)), ("b", None, hour(1)), ("b", "text", hour(1)),
        ("c", "x", None), ("c", "y", hour(0)), ("d", "only", None),
    ]
    made = [{"article_id": i, "body": body, "ingested_at": at, "ingestion_date": day} for i, body, at in rows]
    fields = {f.name: f.dataType for f in schemas.BRONZE}
    df = spark.createDataFrame(made, "article_id string, body string, ingested_at timestamp, ingestion_date date")
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in fields.items()
    ])


def test_newest_holds_a_record_once(spark):
    bronze = _bronze(spark)
    found = newest(bronze)
    columns = schemas.BRONZE.fieldNames()
    assert found.columns == columns
    got, wanted = (sorted(map(str, df.select(*columns).collect())) for df in (found, dedup_bronze(bronze)))
    assert got == wanted and len(got) == 4
    assert "min_by" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_staged_files_are_compressed(spark, tmp_path):
    rows = _bronze(spark).select(*[
        F.col(c).cast(t) for c, t in [(f.name, f.dataType) for f in schemas.STAGING]
    ])
    folder = write_staging(rows, str(tmp_path), "2025-01-01", "r")
    assert all(f.endswith(".json.gz") for f in os.listdir(folder) if f.startswith("part-"))
    assert read_staging(spark, folder).select(*KEY).count() == 7
