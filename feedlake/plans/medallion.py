"""Cleaning, dedup, chunks: silver and gold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import fixed
from feedlake.functions import text
from feedlake.functions.chunks import chunk_windows, token_estimate
from feedlake.operators.gold import chunks_before
from feedlake.operators.medallion import run_medallion
from feedlake.operators.silver import article_metadata, clean_articles, dedup_first, dedup_latest
from feedlake.operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, describe_run, estimates, merge_runs, read_runs, record_run,
)
from feedlake.plans import adapters as a
from feedlake.plans import sql as s
from feedlake.plans.registry import query
from feedlake.plans.sql import with_ctes
from feedlake.profiles import CLUSTER, LOCAL
from feedlake.session import broadcast_if_small, materialize, shared_dir
from feedlake.sources.staging import write_staging

SILVER_COLUMNS = (
    "article_id, feed_id, region, title, content, content_hash, language, published_at, "
    "source_url, ingestion_date"
)
GOLD_COLUMNS = (
    "chunk_id, article_id, feed_id, region, language, chunk_index, chunk_text, token_count, "
    "published_at, source_url, ingestion_date"
)

# Columns are made by functions: they need a session, which importing has not.
MakeColumn = Callable[[], Column]


def _of_documents(**columns: MakeColumn):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return a.documents(spark, d).select("doc_id", *[c().alias(n) for n, c in columns.items()])

    return run


def _of_articles(**columns: MakeColumn):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return a.articles(spark, d).select(
            "article_id", *[c().alias(n) for n, c in columns.items()]
        )

    return run


def _windows(spec):
    def run(spark: SparkSession, d: str) -> DataFrame:
        windows = chunk_windows(F.col("text"), spec)
        return a.documents(spark, d).select(
            "doc_id", F.posexplode(windows).alias("chunk_index", "chunk_text")
        )

    return run


def metadata_entries(spark: SparkSession, d: str) -> DataFrame:
    return a.articles(spark, d).select("article_id", F.explode(article_metadata()))


def long_articles(spark: SparkSession, d: str) -> DataFrame:
    return clean_articles(a.bronze(spark, d)).select("article_id", "content")


def latest(spark: SparkSession, d: str) -> DataFrame:
    rows = clean_articles(a.bronze(spark, d))
    return dedup_latest(rows).select("article_id", "content_hash", "ingestion_date", "ingested_at")


def first(spark: SparkSession, d: str) -> DataFrame:
    rows = clean_articles(a.bronze(spark, d), LOCAL)
    return dedup_first(rows, ["ordinal"]).select(
        "article_id", "content_hash", "ingestion_date", "ingested_at"
    )


def _without(columns: list[str], build):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return build(spark, d).drop(*columns)

    return run


def gold_by_region(spark: SparkSession, d: str) -> DataFrame:
    """The flagship query: documents to chunks, counted per region."""
    return a.gold(spark, d).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum("token_count").alias("n_tokens"),
        F.max("chunk_index").alias("max_chunk_index"),
    )


def chunk_budget(spark: SparkSession, d: str) -> DataFrame:
    """How many chunks come before each article's; a sample is a filter on that."""
    cleaned = clean_articles(a.bronze(spark, d), LOCAL, a.as_of())
    return chunks_before(dedup_first(cleaned, ["ordinal"]), "ordinal", LOCAL, ["article_id"]).select(
        "article_id", "n_chunks", "chunks_before"
    )


def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    """Stage all articles, and copies that break the contract; run the batch job, return its counts."""
    root = shared_dir(spark, "job")
    rows = a.staged(a.articles(spark, d))
    broken = a.staged(a.articles(spark, d).filter("doc_id % 40 = 0")).withColumns(
        {"article_id": F.concat(F.lit("x"), "article_id"), "region": F.lit(None).cast("string")}
    )
    staged = write_staging(rows.unionByName(broken), f"{root}/staging", a.RUN_DATE, "run")
    counts = run_medallion(spark, staged, root, as_of=a.as_of())
    return spark.createDataFrame(list(counts.items()), "stage string, n_rows bigint")


def run_sketches(spark: SparkSession, d: str) -> DataFrame:
    """Gold in three runs, each recorded as sketches; the runs merged per date and region.

    Few feeds are counted exactly. Articles and the median length are held against exact figures.
    """
    path = shared_dir(spark, "runs")
    by = ["ingestion_date", "region"]
    gold = materialize(a.gold(spark, d).select(*by, "feed_id", "article_id", "chunk_index", "chunk_text"), "gold")
    for run in range(3):
        rows = gold.filter(F.col("chunk_index") % 3 == run)
        record_run(path, describe_run(rows, f"run{run}", by, ["feed_id", "article_id"], ["chunk_text"]))
    shares = {"min": 0.0, "median": 0.5, "max": 1.0}
    seen = materialize(estimates(merge_runs(read_runs(spark, path), by), shares), "seen")
    length, median = F.length("chunk_text"), F.col("chunk_text_median")
    exact = gold.join(broadcast_if_small(seen.select(*by, "chunk_text_median")), by).groupBy(*by).agg(
        F.count_distinct("article_id").alias("articles"),
        F.avg((length < median).cast("int")).alias("below"), F.avg((length <= median).cast("int")).alias("upto"),
    )
    return seen.join(exact, by).select(
        *by, "n_runs", "n_rows", F.col("feed_id_distinct").alias("feeds"),
        F.col("chunk_text_min").alias("shortest"), F.col("chunk_text_max").alias("longest"),
        (F.abs(F.col("article_id_distinct") / F.col("articles") - 1) <= DISTINCT_ERROR).alias("articles_near"),
        ((F.col("below") <= 0.5 + RANK_ERROR) & (F.col("upto") >= 0.5 - RANK_ERROR)).alias("median_near"),
    )


def _windows_sql(size: int, overlap: int) -> str:
    rows = s.chunks(
        size, overlap, "(SELECT doc_id, text AS content FROM documents WHERE text <> '')", "doc_id"
    )
    return f"SELECT * FROM ({rows})"


_LATEST = "SELECT article_id, content_hash, ingestion_date, ingested_at FROM "

QUERIES = {
    "normalize_text": query(
        _of_documents(clean=lambda: text.normalize_text(F.col("text"))),
        f"SELECT doc_id, {s.normalize('text')} AS clean FROM documents",
    ),
    "normalize_text_unicode": query(
        _of_documents(clean=lambda: text.normalize_text(F.col("text"), unicode=True)),
        f"SELECT doc_id, {s.normalize_unicode('text')} AS clean FROM documents",
    ),
    "content_pick": query(
        _of_articles(
            content=lambda: text.first_present(F.col("body"), F.col("summary"), F.col("title"))
        ),
        with_ctes(
            "articles",
            select="SELECT article_id, coalesce(body, summary, title) AS content FROM articles",
        ),
    ),
    "content_pick_nonempty": query(
        _of_articles(
            content=lambda: text.first_present(
                F.when(F.col("doc_id") % 4 != 0, F.col("body")).otherwise(""),
                F.col("summary"), F.col("title"), skip_empty=True,
            )
        ),
        with_ctes(
            "articles",
            select="SELECT article_id, CASE WHEN doc_id % 4 <> 0 AND body IS NOT NULL "
            "AND body <> '' THEN body WHEN summary <> '' THEN summary "
            "ELSE coalesce(title, '') END AS content FROM articles",
        ),
    ),
    "content_hash": query(
        _of_documents(content_hash=lambda: text.content_hash(F.col("text"))),
        f"SELECT doc_id, {s.content_hash('text')} AS content_hash FROM documents",
    ),
    "content_hash_cs": query(
        _of_documents(content_hash=lambda: text.content_hash(F.col("text"), case_sensitive=True)),
        "SELECT doc_id, sha256(text) AS content_hash FROM documents",
    ),
    "language_tag": query(
        _of_articles(
            language=lambda: text.language_tag(F.col("language_hint")),
            language_or_unknown=lambda: text.language_tag(
                F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("language_hint")),
                empty_is_unknown=True,
            ),
        ),
        with_ctes(
            "articles",
            select="SELECT article_id, coalesce(lower(language_hint), 'unknown') AS language, "
            "CASE WHEN doc_id % 5 = 0 OR language_hint IS NULL THEN 'unknown' "
            "ELSE lower(language_hint) END AS language_or_unknown FROM articles",
        ),
    ),
    "article_metadata": query(
        metadata_entries,
        with_ctes(
            "articles",
            select="SELECT article_id, 'feed_id' AS key, feed_id AS value FROM articles "
            "UNION ALL SELECT article_id, 'region', region FROM articles",
        ),
    ),
    "min_content": query(
        long_articles,
        with_ctes(
            "articles",
            select="SELECT * FROM (SELECT article_id, "
            f"{s.normalize('coalesce(body, summary, title)')} AS content FROM articles) "
            f"WHERE length(content) > {fixed.MIN_CONTENT_CHARS}",
        ),
    ),
    "dedup_latest": query(latest, with_ctes("silver", select=_LATEST + "silver")),
    "dedup_first": query(first, with_ctes("local_silver", select=_LATEST + "local_silver")),
    "silver_articles": query(
        _without(["metadata", "processed_at"], a.silver),
        with_ctes("silver", select=f"SELECT {SILVER_COLUMNS} FROM silver"),
    ),
    "silver_articles_local": query(
        _without(["metadata", "processed_at"], a.local_silver),
        with_ctes("local_silver", select=f"SELECT {SILVER_COLUMNS} FROM local_silver"),
    ),
    "chunk_windows": query(_windows(CLUSTER.chunks), _windows_sql(384, 48)),
    "chunk_windows_380": query(_windows(LOCAL.chunks), _windows_sql(380, 60)),
    "token_estimate": query(
        _of_documents(token_count=lambda: token_estimate(F.col("text"))),
        f"SELECT doc_id, {s.tokens('text')} AS token_count FROM documents",
    ),
    "gold_chunks": query(
        _without(["metadata", "created_at", "embedded_at"], a.gold),
        with_ctes("gold", select=f"SELECT {GOLD_COLUMNS} FROM gold"),
    ),
    "gold_chunks_local": query(
        _without(["metadata", "created_at", "embedded_at"], a.local_gold),
        with_ctes("local_gold", select=f"SELECT {GOLD_COLUMNS} FROM local_gold"),
    ),
    "gold_by_region": query(
        gold_by_region,
        with_ctes(
            "gold",
            select="SELECT region, count(*) AS n_chunks, sum(token_count)::BIGINT AS n_tokens, "
            "max(chunk_index) AS max_chunk_index FROM gold GROUP BY region",
        ),
    ),
    "chunk_budget": query(
        chunk_budget,
        with_ctes(
            "local_gold",
            select="SELECT article_id, n AS n_chunks, coalesce(sum(n) OVER (ORDER BY ordinal ROWS "
            "BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chunks_before FROM ("
            "SELECT article_id, ordinal, count(*) AS n FROM local_gold GROUP BY ALL)",
        ),
    ),
    "stage_counts": query(
        stage_counts,
        with_ctes(
            "silver", "gold",
            select="SELECT 'bronze' AS stage, count(*) AS n_rows FROM articles "
            "UNION ALL SELECT 'silver', count(*) FROM silver "
            "UNION ALL SELECT 'gold', count(*) FROM gold "
            "UNION ALL SELECT 'quarantined', count(*) FROM documents WHERE doc_id % 40 = 0",
        ),
    ),
    "run_sketches": query(
        run_sketches,
        with_ctes(
            "gold",
            select="SELECT ingestion_date, region, count(DISTINCT chunk_index % 3) AS n_runs, "
            "count(*) AS n_rows, count(DISTINCT feed_id) AS feeds, min(length(chunk_text)) AS shortest, "
            "max(length(chunk_text)) AS longest, true AS articles_near, true AS median_near "
            "FROM gold GROUP BY ALL",
        ),
    ),
}
