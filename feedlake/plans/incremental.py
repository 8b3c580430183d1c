"""Streams over staged files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators.bronze import KEY, load_bronze
from feedlake.operators.vectors import read_gold, run_embedding, vector_table
from feedlake.plans import adapters as a
from feedlake.plans.registry import query
from feedlake.plans.sql import BRONZE_COLUMNS, with_ctes
from feedlake.session import shared_dir
from feedlake.sources.staging import write_staging
from feedlake.sources.tables import date_slice, read_table
from feedlake.streaming.incremental import (
    append_new, first_seen, staged_stream, stream_medallion, upsert_latest, upsert_new,
)

DATES = ("2025-01-01", "2025-01-02", "2025-01-03")


def _stage(rows: DataFrame, root: str, run: str) -> None:
    for date in DATES:
        write_staging(date_slice(rows, date), f"{root}/staging", date, run)


def stream_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Two passes of the stream, with more files staged in between."""
    root = shared_dir(spark, "stream")
    staged = a.staged(a.articles(spark, d))
    for date in DATES:
        write_staging(date_slice(staged, date), f"{root}/staging", date, "run")
        append_new(spark, f"{root}/staging", f"{root}/bronze", f"{root}/checkpoint")
    return spark.read.schema(schemas.BRONZE).parquet(f"{root}/bronze")


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The late copies come first, then the older originals, which must not win."""
    root = shared_dir(spark, "stream")
    base = a.articles(spark, d)
    for run, rows in (("late", a.late_copies(base)), ("base", base)):
        _stage(a.staged(rows), root, run)
        upsert_new(spark, f"{root}/staging", f"{root}/bronze", f"{root}/checkpoint")
    return read_table(spark, f"{root}/bronze", schemas.BRONZE)


def stream_latest(spark: SparkSession, d: str) -> DataFrame:
    """The late copies, then the older originals, then the copies again: the newest of each from the stream's state."""
    root = shared_dir(spark, "stream")
    base = a.articles(spark, d)
    copies = a.late_copies(base)
    for run, rows in (("late", copies), ("base", base), ("again", copies)):
        _stage(a.staged(rows), root, run)
        upsert_latest(spark, f"{root}/staging", f"{root}/bronze", f"{root}/checkpoint", delay="5 days")
    return read_table(spark, f"{root}/bronze", schemas.BRONZE)


def stream_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the articles and their late copies, deduplicated in the stream's own state."""
    root = shared_dir(spark, "stream")
    _stage(a.staged(a.articles_dup(spark, d)), root, "run")
    seen = first_seen(load_bronze(staged_stream(spark, f"{root}/staging")))
    write = seen.select(*KEY).writeStream.format("parquet").option(
        "checkpointLocation", f"{root}/checkpoint"
    )
    write.trigger(availableNow=True).start(f"{root}/keys").awaitTermination()
    return spark.read.schema(seen.select(*KEY).schema).parquet(f"{root}/keys")


def incremental_medallion(spark: SparkSession, d: str) -> DataFrame:
    """Three hours of files: half of the articles, the rest, then shorter copies of the French ones.

    After each hour the stream catches up and what is due is embedded. Nobody reads the vectors
    of the hour before any more.
    """
    root = shared_dir(spark, "hourly")
    base = a.articles(spark, d)
    hours = (base.filter("doc_id % 2 = 0"), base.filter("doc_id % 2 = 1"), a.shorter_copies(base))
    for hour, rows in enumerate(hours):
        _stage(a.staged(rows), root, f"hour{hour}")
        stream_medallion(
            spark, f"{root}/staging", f"{root}/lake", f"{root}/checkpoint", as_of=a.as_of(),
            vector_path=f"{root}/vectors",
        )
        run_embedding(spark, f"{root}/lake/gold", f"{root}/vectors", a.as_of())
        vector_table(spark, f"{root}/vectors").drop_versions(keep=1)
    gold = read_gold(spark, f"{root}/lake/gold").select(
        "chunk_id", "chunk_text", "ingestion_date", F.col("embedded_at").isNotNull().alias("embedded")
    )
    vectors = vector_table(spark, f"{root}/vectors").read().select(
        F.col("id").alias("chunk_id"), F.lit(True).alias("has_vector")
    )
    return gold.join(vectors, "chunk_id", "full")


QUERIES = {
    "incremental_medallion": query(
        incremental_medallion,
        with_ctes(
            "hourly_gold",
            select="SELECT chunk_id, chunk_text, ingestion_date, true AS embedded, true AS has_vector "
            "FROM hourly_gold",
        ),
    ),
    "stream_first_seen": query(
        stream_first_seen,
        with_ctes("articles", select="SELECT DISTINCT article_id, ingestion_date FROM articles"),
    ),
    "stream_bronze": query(
        stream_bronze, with_ctes("articles", select=f"SELECT {BRONZE_COLUMNS} FROM articles")
    ),
    "stream_latest": query(
        stream_latest, with_ctes("bronze_dup", select=f"SELECT {BRONZE_COLUMNS} FROM bronze_dup")
    ),
    "stream_upsert": query(
        stream_upsert, with_ctes("bronze_dup", select=f"SELECT {BRONZE_COLUMNS} FROM bronze_dup")
    ),
}
