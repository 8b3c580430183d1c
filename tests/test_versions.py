"""Versioned tables: switches, buckets, repeated keys, and what readers see."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from feedlake import schemas
from feedlake.operators.medallion import load_records
from feedlake.operators.vectors import (
    STAMP_KEY, due_chunks, newest_of_key, read_gold, read_stamps, run_embedding, stamps_path, upsert_vectors, vector_table,
)
from feedlake.profiles import CLUSTER, LOCAL
from feedlake.session import materialize, shared_dir
from feedlake.sources import versions
from feedlake.sources.tables import append_table, read_table
from feedlake.sources.versions import MERGE_CONF, VersionedTable, name_at

SCHEMA = StructType([
    StructField("k", StringType()), StructField("v", IntegerType()), StructField("part", StringType()), StructField("day", DateType()),
])


def made(spark, buckets=0, **more):
    path = shared_dir(spark, "versions")
    by = (("k",), buckets) if buckets else ()
    return VersionedTable(spark, name_at(path), path, SCHEMA, ("day", "part"), *by, **more).create()


def frame(spark, rows):
    return spark.createDataFrame([(k, v, p, dt.date(2025, 1, d)) for k, v, p, d in rows], SCHEMA)


def content(df):
    return sorted((r["k"], r["v"], r["part"], r["day"].day) for r in df.collect())


@pytest.mark.parametrize("buckets", [0, 3])
def test_switch_replaces_partitions_in_scope(spark, buckets):
    table = made(spark, buckets)
    assert table.read().schema.fieldNames() == SCHEMA.fieldNames() and table.read().count() == 0
    base = [("a", 1, "x y:z/%", 1), ("b", 1, "it's", 1), ("c", 1, "q", 2)]
    table.switch(frame(spark, base), frame(spark, base))
    assert content(table.read()) == base
    # One partition gets other rows, one none, one is new, one stays.
    new = [("a", 2, "x y:z/%", 1), ("d", 2, "n", 3)]
    table.switch(frame(spark, new), frame(spark, [*new, ("b", 1, "it's", 1)]))
    assert content(table.read()) == sorted([*new, ("c", 1, "q", 2)])
    assert made(spark).create().read().count() == 0


def test_null_and_empty_partitions(spark):
    table = made(spark)
    base = [("a", 1, None, 1), ("b", 1, "", 1), ("c", 1, "x", 1)]
    table.switch(frame(spark, base), frame(spark, base))
    assert sorted(r["k"] for r in table.read().filter("part IS NULL").collect()) == ["a", "b"]
    table.switch(frame(spark, [("n", 2, None, 1)]), frame(spark, [("", 0, "", 1)]))
    assert sorted(r["k"] for r in table.read().collect()) == ["c", "n"]
    table.drop_versions(keep=1)
    assert sorted(r["k"] for r in table.read().collect()) == ["c", "n"]


def test_readers_keep_what_they_opened_and_a_killed_run_leaves_the_old_state(spark, monkeypatch):
    table = made(spark, 2)
    base = [("a", 1, "x", 1), ("b", 1, "y", 2)]
    table.upsert(frame(spark, base), ["day", "part", "k"], [F.col("v")])
    opened = table.read()
    table.upsert(frame(spark, [("a", 2, "x", 1)]), ["day", "part", "k"], [F.col("v")])
    assert content(opened) == base and content(table.read()) == [("a", 2, "x", 1), ("b", 1, "y", 2)]
    state = content(table.read())
    with monkeypatch.context() as m:
        def killed(*_):
            raise RuntimeError("killed")

        m.setattr(VersionedTable, "_show", killed)
        with pytest.raises(RuntimeError, match="killed"):
            table.upsert(frame(spark, [("a", 3, "x", 1), ("z", 3, "y", 2)]), ["day", "part", "k"], [F.col("v")])
    assert content(table.read()) == state
    table.upsert(frame(spark, [("c", 4, "x", 1)]), ["day", "part", "k"], [F.col("v")])
    assert content(table.read()) == sorted([*state, ("c", 4, "x", 1)])
    before = table.read()
    table.drop_versions(keep=2)
    assert content(before) == content(table.read())
    table.drop_versions(keep=1)
    assert content(table.read()) == sorted([*state, ("c", 4, "x", 1)])
    names = [t.name for t in spark.catalog.listTables(pattern=f"{table.name}__v*")]
    assert len(names) == 1
    on_disk = spark.read.option("basePath", table.path).parquet(table.path).select("version").distinct().count()
    assert on_disk == len({p["version"] for p in table.partitions()})


def test_repeated_keys_and_order(spark):
    table = made(spark, 4)
    rows = [(f"k{i % 10}", i, "x", 1) for i in range(100)]
    for _ in range(2):
        table.upsert(frame(spark, rows).repartition(5), ["day", "part", "k"], [F.col("v").desc()])
        assert content(table.read()) == sorted((f"k{i}", 90 + i, "x", 1) for i in range(10))
    table.delete(frame(spark, [("k3", 0, "x", 1), ("no", 0, "x", 1), ("k4", 0, "other", 1)]), ["day", "part", "k"])
    assert len(content(table.read())) == 9
    with pytest.raises(PySparkException, match="NULL in"):
        table.upsert(frame(spark, [(None, 1, "x", 1)]), ["day", "part", "k"], [F.col("v")])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_does_not_shuffle_the_table(spark):
    table = vector_table(spark, shared_dir(spark, "vectors"), buckets=4)
    rows = [("emea", f"i{i}", [float(i)], "en", None) for i in range(200)]
    source = spark.createDataFrame(rows, schemas.VECTORS)
    upsert_vectors(table, source)
    with versions._settings(spark, {**MERGE_CONF, "spark.sql.adaptive.enabled": "false"}):
        source = materialize(source, "source")
        plan = _plan(table.merged(source, ["namespace", "id"]))
    table_side, source_side = _sides(plan)
    assert "Bucketed: true" in table_side and "Exchange" not in table_side
    assert "Exchange" in source_side


def _sides(plan):
    """The two inputs of the join, as the plan's tree shows them."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    left = next(i for i in range(at, len(lines)) if lines[i].lstrip(" :").startswith("- "))
    depth = lines[left].index(":- ") if ":- " in lines[left] else 0
    right = next(i for i in range(left + 1, len(lines)) if lines[i][depth:].startswith("+- "))
    return "\n".join(lines[left:right]), "\n".join(lines[right:])


def _gold(spark, rows):
    now = dt.datetime(2025, 1, 1)
    data = [
        (i, "a", "f", region, "en", 0, text, 1, None, None, None, now, dt.date(2025, 1, day), None)
        for i, region, text, day in rows
    ]
    return spark.createDataFrame(data, schemas.GOLD)


def vectors_of(spark, path):
    return {(r["namespace"], r["id"]): r["metadata"] for r in vector_table(spark, path).read().collect()}


def test_one_vector_for_a_chunk_on_several_dates(spark):
    root = shared_dir(spark, "dates")
    gold = [("a_0", "emea", "old words", 1), ("a_0", "emea", "new words", 3), ("a_0", "apac", "other", 2), ("b_0", "emea", "b", 1)]
    append_table(_gold(spark, gold), f"{root}/gold", schemas.GOLD_PARTITIONS)
    stamp = F.lit("2025-02-01").cast("timestamp")
    counts = {r[0]: r[1] for r in run_embedding(spark, f"{root}/gold", f"{root}/vectors", stamp).collect()}
    assert counts == {"emea": 2, "apac": 1}
    found = vectors_of(spark, f"{root}/vectors")
    assert set(found) == {("emea", "a_0"), ("apac", "a_0"), ("emea", "b_0")} and "new words" in found["emea", "a_0"]
    assert read_gold(spark, f"{root}/gold").filter("embedded_at IS NULL").count() == 0
    # A copy of an older date comes late: it is stamped, the newer vector stays. A newer one replaces it.
    append_table(_gold(spark, [("a_0", "emea", "late words", 2)]), f"{root}/gold", schemas.GOLD_PARTITIONS)
    assert run_embedding(spark, f"{root}/gold", f"{root}/vectors", stamp).count() == 0
    assert "new words" in vectors_of(spark, f"{root}/vectors")["emea", "a_0"]
    append_table(_gold(spark, [("a_0", "emea", "newest words", 4)]), f"{root}/gold", schemas.GOLD_PARTITIONS)
    run_embedding(spark, f"{root}/gold", f"{root}/vectors", stamp, date="2025-01-04")
    assert "newest words" in vectors_of(spark, f"{root}/vectors")["emea", "a_0"]
    assert read_gold(spark, f"{root}/gold").filter("embedded_at IS NULL").count() == 0


def test_stamps_move_no_text(spark):
    """Gold's files stay as they are, and the queue reads no texts."""
    root = shared_dir(spark, "stamps")
    append_table(_gold(spark, [(f"c{i}", "emea", "text", 1 + i % 2) for i in range(20)]), f"{root}/gold", schemas.GOLD_PARTITIONS)

    def files():
        gold = read_table(spark, f"{root}/gold", schemas.GOLD)
        return {tuple(r) for r in gold.select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}

    kept = files()
    for run, due in ((1, 13), (2, 6), (3, 0)):
        run_embedding(spark, f"{root}/gold", f"{root}/vectors", F.lit(f"2025-02-0{run}").cast("timestamp"), max_rows=7)
        gold, stamps = read_table(spark, f"{root}/gold", schemas.GOLD), read_stamps(spark, f"{root}/gold")
        queue = due_chunks(gold, stamps)
        assert queue.count() == due
    assert files() == kept
    assert "chunk_text" not in _plan(newest_of_key(queue, stamps)).split("ReadSchema", 1)[1]
    stamped = read_gold(spark, f"{root}/gold").groupBy("embedded_at").count().collect()
    assert sorted(r["count"] for r in stamped) == [6, 7, 7]
    assert spark.read.parquet(stamps_path(f"{root}/gold")).columns == ["chunk_id", "embedded_at", *schemas.GOLD_PARTITIONS]


def test_a_changed_chunk_is_due_again(spark):
    root = shared_dir(spark, "changed")
    long = " ".join(f"word{i}" for i in range(500))

    def bronze(text, hour):
        rows = [(i, "f", "emea", "rss", "u", "t", None, body, None, "en", "{}", dt.datetime(2025, 1, 1, hour), dt.date(2025, 1, 1))
                for i, body in (("a", text), ("b", long[::-1]))]
        return spark.createDataFrame(rows, schemas.BRONZE)

    stamp = F.lit("2025-02-01").cast("timestamp")
    load_records(spark, bronze(long, 1), root, vector_path=f"{root}/vectors")
    run_embedding(spark, f"{root}/gold", f"{root}/vectors", stamp)
    load_records(spark, bronze(long, 2), root, vector_path=f"{root}/vectors")
    gold = read_table(spark, f"{root}/gold", schemas.GOLD)
    assert due_chunks(gold, read_stamps(spark, f"{root}/gold")).count() == 0
    load_records(spark, bronze(long[:-8], 3), root, vector_path=f"{root}/vectors")
    gold = read_table(spark, f"{root}/gold", schemas.GOLD)
    due = due_chunks(gold, read_stamps(spark, f"{root}/gold"))
    assert [r["chunk_id"] for r in due.select(*STAMP_KEY).collect()] == ["a_1"]


def _read_rows(spark, since):
    """Rows that scans have put out since a job number, by the files' table."""
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
    return sum(s.inputRecords() for s in (stages.apply(i) for i in range(stages.size())) if s.stageId() >= since)


@pytest.mark.parametrize("profile", [LOCAL, CLUSTER])
def test_an_hour_reads_what_it_changes(spark, profile):
    """A superseded copy comes back, a copy on another date wins, and rows read do not grow with the table."""
    def bronze(rows):
        return spark.createDataFrame(
            [(i, "f", "emea", "rss", "u", f"t{hour}", None, text, None, "en", "{}", dt.datetime(2025, 1, 1, hour), dt.date(2025, 1, day))
             for i, text, hour, day in rows], schemas.BRONZE)

    def text(n):
        return f"Number {n} of all the articles that are there. " * 3

    def tables(root):
        gold = read_table(spark, f"{root}/gold", schemas.GOLD).select("chunk_id", "chunk_text", "ingestion_date")
        silver = read_table(spark, f"{root}/silver", schemas.SILVER).select("article_id", "title", "content", "ingestion_date")
        return sorted(map(tuple, gold.collect())), sorted(map(tuple, silver.collect()))

    base = [(f"b{i}", text(i % 40), 1 + i % 3, 1 + i % 5) for i in range(400)]
    hours = [base, [("b0", text(1000), 5, 1), ("new", text(7), 6, 2)], [("b7", text(8), 7, 3), ("b8", "short", 8, 4)], [("b0", text(0), 9, 1)]]
    root, whole = shared_dir(spark, "hours"), shared_dir(spark, "whole")
    last = {}
    for rows in hours:
        load_records(spark, bronze(rows), root, profile)
        for i, *rest in rows:
            last[i, rest[2]] = (i, *rest)
    load_records(spark, bronze(list(last.values())), whole, profile)
    assert tables(root) == tables(whole)
    before = max([-1, *_stage_ids(spark)]) + 1
    counts = load_records(spark, bronze(hours[-1]), root, profile)
    assert tables(root) == tables(whole)
    assert 1 <= counts["silver"] <= 2
    # Bronze is rewritten where the record lies: one of five dates; contents and chunks only near the change.
    texts = spark.sparkContext._jsc.sc().statusStore() is not None and _read_rows(spark, before)
    assert texts < 3 * len(base), texts


def _stage_ids(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    gateway = spark.sparkContext._gateway
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
    return [stages.apply(i).stageId() for i in range(stages.size())]
