"""The batch job, the embedding job and the streams, run again and over bad data."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators.bronze import KEY, load_bronze
from feedlake.operators.gold import sample_articles
from feedlake.operators.medallion import run_medallion
from feedlake.operators.silver import build_silver, dedup_latest
from feedlake.operators.vectors import pending_batch, read_gold, run_embedding, vector_table
from feedlake.plans import adapters as a
from feedlake.profiles import LOCAL
from feedlake.session import broadcast_if_small, shared_dir
from feedlake.sources.staging import read_staging, write_staging
from feedlake.sources.tables import read_table
from feedlake.streaming.incremental import (
    append_new, first_seen, newest, staged_stream, stream_medallion, upsert_latest, upsert_new,
)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_batch_job_run_twice(spark, sf_dir):
    root = shared_dir(spark, "job")
    staged = write_staging(a.staged(a.articles(spark, sf_dir)), f"{root}/staging", "2025-01-01", "r")
    first = run_medallion(spark, staged, root)
    gold = rows(read_table(spark, f"{root}/gold", schemas.GOLD), "chunk_id", "chunk_text")
    assert run_medallion(spark, staged, root) == first
    assert (first["bronze"], first["quarantined"]) == (200, 0) and first["silver"] < 200 < first["gold"]
    again = rows(read_table(spark, f"{root}/gold", schemas.GOLD), "chunk_id", "chunk_text")
    assert again == gold and len(gold) == first["gold"]
    # One date only, and plain appends, which do double the rows.
    one = run_medallion(spark, staged, shared_dir(spark, "job"), date="2025-01-02")
    assert 0 < one["silver"] < first["silver"]
    other = shared_dir(spark, "job")
    for _ in range(2):
        run_medallion(spark, staged, other, append_only=True)
    assert read_table(spark, f"{other}/bronze", schemas.BRONZE).count() == 400


def test_embedding_job_in_bounded_runs(spark, sf_dir):
    root = shared_dir(spark, "job")
    gold, vectors = f"{root}/gold", f"{root}/vectors"
    staged = write_staging(a.staged(a.articles(spark, sf_dir)), f"{root}/staging", "2025-01-01", "r")
    total = run_medallion(spark, staged, root)["gold"]
    sent = []
    for run in range(4):
        counts = run_embedding(
            spark, gold, vectors, F.lit(f"2025-02-0{run + 1}").cast("timestamp"), max_rows=110
        )
        sent.append(sum(r["n_vectors"] for r in counts.collect()))
        pending = pending_batch(read_gold(spark, gold), max_rows=None).count()
        assert pending == max(total - 110 * (run + 1), 0)
    assert sent == [min(110, max(total - 110 * i, 0)) for i in range(4)] and sum(sent) == total
    table = vector_table(spark, vectors).read()
    assert table.count() == total
    assert {r[0] for r in table.select("namespace").distinct().collect()} == {
        "global", "emea", "americas"
    }


def _article(i, text, hour, **more):
    row = {
        "article_id": i, "feed_id": "f", "region": "emea", "source_type": "rss", "source_url": "u",
        "title": "t", "summary": None, "body": text, "published_at": None, "language_hint": "en",
        "raw_payload": "{}", "ingested_at": f"2025-01-01T{hour:02d}:00:00+00:00",
        "ingestion_date": dt.date(2025, 1, 1),
    }
    return {**row, **more}


@pytest.mark.parametrize("streamed", [False, True])
def test_hourly_runs_end_like_one_run(spark, streamed):
    """A copy supersedes an article, an article gets shorter, another loses its text."""
    long = " ".join(f"word{i}" for i in range(900))
    hours = [
        [_article("a", "Same text. " * 9, 1), _article("b", long, 1), _article("c", "Other words here. " * 9, 1)],
        [_article("d", "Same text. " * 9, 2), _article("b", long[:600], 2)],
        [_article("c", "short", 3), _article(None, "x" * 90, 3), _article("e", "x" * 90, 3, region="")],
    ]
    root, whole = shared_dir(spark, "hourly"), shared_dir(spark, "whole")
    for h, rows_of in enumerate(hours):
        staged = spark.createDataFrame(rows_of, schemas.STAGING)
        folder = write_staging(staged, f"{root}/staging", "2025-01-01", f"h{h}")
        if streamed:
            stream_medallion(spark, f"{root}/staging", root, f"{root}/c", vector_path=f"{root}/vectors")
            counts = {}
        else:
            counts = run_medallion(spark, folder, root, vector_path=f"{root}/vectors")
        run_embedding(spark, f"{root}/gold", f"{root}/vectors", F.lit("2025-02-01").cast("timestamp"))
    assert streamed or counts["quarantined"] == 2
    every = run_medallion(spark, f"{root}/staging", whole)
    assert every["quarantined"] == 2
    for name, schema, columns in (
        ("bronze", schemas.BRONZE, ["article_id", "body"]), ("silver", schemas.SILVER, ["article_id", "content"]),
        ("gold", schemas.GOLD, ["chunk_id", "chunk_text"]),
    ):
        one = rows(read_table(spark, f"{whole}/{name}", schema), *columns)
        assert rows(read_table(spark, f"{root}/{name}", schema), *columns) == one
    gold = read_gold(spark, f"{root}/gold")
    assert rows(gold, "chunk_id") == [("b_0",), ("d_0",)]
    assert gold.filter("embedded_at IS NULL").count() == 0
    assert rows(vector_table(spark, f"{root}/vectors").read(), "id") == [("b_0",), ("d_0",)]


def test_input_order_is_that_of_the_files(spark):
    root = shared_dir(spark, "order")
    staged = [_article(f"z{9 - i}", f"Text number {i % 3} of the feed. " * 4, 1) for i in range(9)]
    for h in range(3):
        part = spark.createDataFrame(staged[3 * h:3 * h + 3], schemas.STAGING).coalesce(1)
        write_staging(part, root, "2025-01-01", f"h{h}")
    bronze = load_bronze(read_staging(spark, root, ordinal="ordinal"))
    kept = build_silver(bronze, LOCAL)
    assert rows(kept, "article_id") == [("z7",), ("z8",), ("z9",)]  # the first of each text
    order = [r[0] for r in bronze.orderBy("ordinal").select("article_id").collect()]
    assert order == [f"z{9 - i}" for i in range(9)]


def test_streams_give_the_batch_answer(spark, sf_dir):
    root = shared_dir(spark, "stream")
    base = a.articles(spark, sf_dir)
    copies = a.late_copies(base)
    write_staging(a.staged(copies), f"{root}/staging", "2025-01-01", "late")
    for bad in range(2):
        upsert_new(spark, f"{root}/staging", f"{root}/t", f"{root}/c", files_per_batch=2)
        write_staging(a.staged(base), f"{root}/staging", "2025-01-02", "base")
    # The files were replaced by the second write of the run, so they are new again.
    upsert_new(spark, f"{root}/staging", f"{root}/t", f"{root}/c")
    from feedlake.operators.bronze import build_bronze

    wanted = build_bronze(a.staged(base.unionByName(copies)))
    table = read_table(spark, f"{root}/t", schemas.BRONZE)
    assert rows(table, *KEY, "title", "ingested_at") == rows(wanted, *KEY, "title", "ingested_at")


def test_append_stream_reads_each_file_once(spark, sf_dir):
    root = shared_dir(spark, "stream")
    staged = a.staged(a.articles(spark, sf_dir))
    write_staging(staged, f"{root}/staging", "2025-01-01", "r")
    for _ in range(3):
        append_new(spark, f"{root}/staging", f"{root}/t", f"{root}/c", files_per_batch=3)
    assert spark.read.schema(schemas.BRONZE).parquet(f"{root}/t").count() == 200


def test_stream_dedup_with_bounded_state(spark, sf_dir):
    root = shared_dir(spark, "stream")
    staged = a.staged(a.articles_dup(spark, sf_dir))
    write_staging(staged, f"{root}/staging", "2025-01-01", "r")
    seen = first_seen(load_bronze(staged_stream(spark, f"{root}/staging")))
    query = seen.writeStream.format("parquet").option("checkpointLocation", f"{root}/c").trigger(
        availableNow=True
    ).start(f"{root}/t")
    query.awaitTermination()
    table = spark.read.schema(schemas.BRONZE).parquet(f"{root}/t")
    assert table.count() == table.select(*KEY).distinct().count() == 200


def test_sample_stops_after_the_article_that_fills_it(spark):
    sizes = [380, 1000, 10, 2000, 380, 700]  # 1, 3, 1, 7, 1, 2 chunks
    df = spark.createDataFrame(
        [(i, " ".join(["w"] * n)) for i, n in enumerate(sizes)], "ordinal long, content string"
    )
    kept = sample_articles(df, "ordinal", 1, LOCAL)
    assert sorted(r["ordinal"] for r in kept.collect()) == [0, 1, 2]  # 5 chunks
    kept = sample_articles(df, "ordinal", 2, LOCAL)
    assert sorted(r["ordinal"] for r in kept.collect()) == [0, 1, 2, 3]  # overshoots to 12


def test_hot_content_is_reduced_before_the_shuffle(spark, sf_dir):
    """Copies that make up most rows leave one row per input partition."""
    n = 2000
    text = "x" * 60
    df = spark.range(0, n, 1, 4).select(
        F.concat(F.lit("a"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("article_id"),
        F.when(F.col("id") % 3 != 0, F.lit(text)).otherwise(
            F.concat(F.lit(text), F.col("id").cast("string"))
        ).alias("content"),
        F.timestamp_seconds(F.col("id") % 7).alias("ingested_at"),
        F.lit("2025-01-01").cast("date").alias("ingestion_date"),
    ).withColumn("content_hash", F.sha2("content", 256))
    out = dedup_latest(df)
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()
    kept = out.filter(F.col("content") == text).collect()
    assert len(kept) == 1
    best = min(f"a{i:05d}" for i in range(n) if i % 3 and i % 7 == 6)
    assert kept[0]["article_id"] == best
    assert out.count() == 1 + len([i for i in range(n) if i % 3 == 0])


def test_broadcast_only_what_is_counted_small(spark):
    small, large = spark.range(10), spark.range(11)
    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hint(broadcast_if_small(small, 10)) and not hint(broadcast_if_small(large, 10))
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"), F.array("id").alias("a"))
    assert hint(broadcast_if_small(wide, 10, 11_000))
    assert not hint(broadcast_if_small(wide, 10, 9_000))


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert shared_dir(spark, "x").startswith(base)


def test_local_profile_keeps_unicode_and_first_copy(spark):
    text = "Über " * 12
    data = [("b", text, 2), ("a", text.strip(), 1), ("c", "x" * 50, 3), ("d", "x" * 49, 4)]
    df = spark.createDataFrame(data, "article_id string, body string, t long").withColumns({
        "feed_id": F.lit("f"), "region": F.lit("r"), "title": F.lit(None).cast("string"),
        "summary": F.lit("s"), "language_hint": F.lit(""), "published_at": F.lit(None),
        "source_url": F.lit("u"), "ingested_at": F.timestamp_seconds("t"),
        "ingestion_date": F.to_date(F.timestamp_seconds(F.col("t") * 86400)),
    })
    local = {r["article_id"]: r for r in build_silver(df, LOCAL).collect()}
    assert set(local) == {"a", "c"} and local["a"]["content"].startswith("Über")
    assert local["a"]["language"] == "unknown"
    cluster = {r["article_id"]: r for r in build_silver(df).collect()}
    # 'ber ' twelve times is too short without its capitals; fifty characters are not over fifty.
    assert set(cluster) == set()
    assert json.loads(json.dumps(local["a"]["metadata"])) == {"feed_id": "f", "region": "r"}


def test_job_needs_a_shared_folder_off_one_machine(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


def test_newest_of_a_key_with_bounded_state(spark):
    """Late records within the delay count, whichever order they come in; state of old dates goes."""
    root = shared_dir(spark, "newest")
    texts = {}

    def stage(run, day, rows):
        staged = [_article(i, text, hour, ingestion_date=dt.date(2025, 1, day)) for i, text, hour in rows]
        for i, text, hour in rows:
            if hour >= texts.get((i, day), ("", -1))[1]:
                texts[i, day] = text, hour
        write_staging(spark.createDataFrame(staged, schemas.STAGING), f"{root}/staging", f"2025-01-{day:02d}", run)

    def catch_up():
        rows = newest(load_bronze(staged_stream(spark, f"{root}/staging")), "3 days")
        query = rows.writeStream.outputMode("update").format("noop").option(
            "checkpointLocation", f"{root}/state"
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        upsert_latest(spark, f"{root}/staging", f"{root}/t", f"{root}/c", delay="3 days")
        progress = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return progress[-1]

    def table():
        rows = read_table(spark, f"{root}/t", schemas.BRONZE).collect()
        return {(r["article_id"], r["ingestion_date"].day): r["body"] for r in rows}

    stage("a", 1, [("x", "old", 1), ("y", "first", 5)])
    assert catch_up() == 2
    stage("b", 3, [("x", "another day", 1)])
    assert catch_up() == 3
    stage("c", 1, [("x", "newer, late", 2), ("y", "older, late", 4)])
    assert catch_up() == 3
    assert table() == {k: text for k, (text, _) in texts.items()}
    assert table()["x", 1] == "newer, late" and table()["y", 1] == "first"
    for day in (9, 10):
        stage("d", day, [("z", f"day {day}", 1)])
        held = catch_up()
    assert held == 2
    before = table()
    stage("e", 1, [("x", "too late", 9)])
    catch_up()
    assert table() == before
