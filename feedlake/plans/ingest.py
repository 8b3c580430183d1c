"""Feeds, entries, staging records and bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.feeds import entry_link, published_at
from feedlake.operators.bronze import dedup_bronze, load_bronze
from feedlake.plans import adapters as a
from feedlake.plans.registry import query
from feedlake.plans.sql import BRONZE_COLUMNS, region_of, with_ctes
from feedlake.session import materialize, shared_dir
from feedlake.sources.feeds import attach_feeds, read_feeds, stage_records
from feedlake.sources.rss import parse_documents
from feedlake.sources.staging import latest_batch, read_staging, write_staging
from feedlake.sources.tables import date_slice

ENTRY_COLUMNS = (
    "feed_id, page_id, title, link, id, published, updated, summary, body, authors, tags, enclosures"
)


def feed_registry(spark: SparkSession, d: str) -> DataFrame:
    path = shared_dir(spark, "feeds")
    a.feeds(spark, d).write.json(path)
    return read_feeds(spark, path)


def _entries(spark: SparkSession, d: str) -> DataFrame:
    return parse_documents(a.feed_documents(spark, d), "xml")


def _plain_lists(entries: DataFrame) -> DataFrame:
    """Lists as text, for clients that compare them."""
    lists = {c: F.array_join(c, ",") for c in ("authors", "tags")}
    return entries.withColumns({**lists, "enclosures": F.array_join("enclosures.href", ",")}).drop("contents")


def rss_entries(spark: SparkSession, d: str) -> DataFrame:
    return _plain_lists(_entries(spark, d))


def _attached(spark: SparkSession, d: str) -> DataFrame:
    # Written, so that the documents are read for it once.
    return attach_feeds(_entries(spark, d), materialize(a.feeds(spark, d), "feeds"))


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return _plain_lists(_attached(spark, d))


def entry_ids(spark: SparkSession, d: str) -> DataFrame:
    return stage_records(_attached(spark, d), a.RUN_TS, a.RUN_DATE).select(
        "article_id", "feed_id", "source_url", "title"
    )


def published(spark: SparkSession, d: str) -> DataFrame:
    return rss_entries(spark, d).select(
        "page_id", "title", published_at(F.col("published"), F.col("updated")).alias("published_at")
    )


def bodies(spark: SparkSession, d: str) -> DataFrame:
    return rss_entries(spark, d).select(
        "page_id", "title", entry_link(F.col("link"), F.col("id")).alias("link"), "body"
    )


def records(spark: SparkSession, d: str) -> DataFrame:
    return stage_records(_attached(spark, d), a.RUN_TS, a.RUN_DATE, url_fallback=True)


def _stage_runs(spark: SparkSession, d: str) -> str:
    """Stage the articles as one run per date; returns the staging root."""
    root = shared_dir(spark, "staging")
    rows = a.staged(a.articles(spark, d))
    for run, date in enumerate(("2025-01-01", "2025-01-02", "2025-01-03")):
        write_staging(date_slice(rows, date), root, date, f"run{run}")
    return root


def staging_scan(spark: SparkSession, d: str) -> DataFrame:
    return read_staging(spark, _stage_runs(spark, d))


def newest_batch(spark: SparkSession, d: str) -> DataFrame:
    return read_staging(spark, latest_batch(spark, _stage_runs(spark, d)))


def one_date(spark: SparkSession, d: str) -> DataFrame:
    return date_slice(a.articles(spark, d), "2025-01-02").drop("doc_id")


def bronze_load(spark: SparkSession, d: str) -> DataFrame:
    """Half of the dates are missing, and one in six times of publication cannot be read."""
    n = F.substring("raw_payload", 11, 20)
    n = F.regexp_extract(n, r"\d+", 0).cast("bigint")
    rows = a.staged(a.articles(spark, d))
    dirty = rows.withColumn("ingestion_date", F.when(n % 2 == 0, F.col("ingestion_date")))
    dirty = dirty.withColumn(
        "published_at", F.when(n % 6 == 0, F.lit("junk")).otherwise(F.col("published_at"))
    )
    return load_bronze(dirty, a.RUN_DATE)


def bronze_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup_bronze(load_bronze(a.staged(a.articles_dup(spark, d))))


_TIME = "TIMESTAMP '2025-01-01' + to_hours(page_id)"
_ENTRIES = f"""
WITH items AS (
  SELECT *, '' AS suffix FROM pages UNION ALL SELECT *, '#2' FROM pages WHERE page_id % 5 = 0
), entries AS (
  SELECT 'src' || page_id % 20 AS feed_id, page_id, 'Page ' || page_id || suffix AS title,
    CASE WHEN page_id % 14 <> 0 THEN url || suffix END AS link,
    CASE WHEN page_id % 7 = 0 THEN url || suffix END AS id,
    CASE page_id % 5
      WHEN 0 THEN strftime({_TIME}, '%a, %d %b %Y %H:%M:%S GMT')
      WHEN 1 THEN strftime({_TIME} + INTERVAL 2 HOUR, '%a, %d %b %Y %H:%M:%S +0200')
      WHEN 2 THEN strftime({_TIME} - INTERVAL 5 HOUR, '%a, %d %b %Y %H:%M:%S EST')
      WHEN 3 THEN strftime({_TIME}, '%Y-%m-%dT%H:%M:%SZ')
      ELSE 'some day' END AS published,
    CASE WHEN page_id % 2 = 0 THEN strftime({_TIME} + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') END
      AS updated,
    CASE WHEN page_id % 2 = 1 THEN trim(html, E' \\t\\r\\n') END AS summary,
    CASE WHEN page_id % 2 = 0 THEN trim(html, E' \\t\\r\\n') END AS body,
    CASE WHEN page_id % 3 = 0 THEN 'ann@news.example,Bob' END AS authors,
    'news,t' || page_id % 4 AS tags,
    CASE WHEN page_id % 6 = 0 THEN 'http://x.example/' || page_id || '.mp3' END AS enclosures,
    CASE WHEN page_id % 5 <> 4 THEN {_TIME}
         WHEN page_id % 2 = 0 THEN {_TIME} + INTERVAL 1 HOUR END AS published_at
  FROM items
), feeds AS (
  SELECT source AS feed_id, {region_of("source")} AS region, min(lang) AS language_hint,
         'rss' AS source_type, 'http://' || source || '/rss' AS url,
         15::INTEGER AS poll_interval_minutes
  FROM documents GROUP BY source
), enriched AS (
  SELECT e.*, region, source_type, language_hint FROM entries e JOIN feeds USING (feed_id)
), identified AS (
  SELECT *, feed_id || '_' || substr(sha256(feed_id || ':' || coalesce(link, id, '')), 1, 32)
    AS article_id FROM enriched
)
"""

# The whole entry; what it lacks is left out.
_PAYLOAD = (
    "'{\"title\": ' || to_json(title) || "
    + " || ".join(
        f"coalesce(', \"{k}\": ' || to_json({k}), '')"
        for k in ("link", "id", "published", "updated", "summary", "body")
    )
    + " || coalesce(', \"contents\": [{\"value\":' || to_json(body) || '}]', '')"
    " || CASE WHEN page_id % 3 = 0 THEN ', \"authors\": [\"ann@news.example\",\"Bob\"]' ELSE '' END"
    " || ', \"tags\": [\"news\",\"t' || page_id % 4 || '\"]'"
    " || coalesce(', \"enclosures\": [{\"href\":' || to_json(enclosures) || "
    "',\"type\":\"audio/mpeg\"}]', '') || '}'"
)

_STAGED_TEXT = with_ctes(
    "articles",
    select="SELECT article_id, feed_id, region, source_type, source_url, title, summary, body, "
    "strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at, language_hint, "
    "'{\"doc_id\":' || doc_id || '}' AS raw_payload, "
    "strftime(ingested_at, '%Y-%m-%dT%H:%M:%S+00:00') AS ingested_at, ingestion_date "
    "FROM articles",
)

QUERIES = {
    "feed_registry": query(feed_registry, _ENTRIES + "SELECT * FROM feeds"),
    "rss_entries": query(rss_entries, _ENTRIES + f"SELECT {ENTRY_COLUMNS} FROM entries"),
    "feed_enrich": query(
        enriched,
        _ENTRIES + f"SELECT {ENTRY_COLUMNS}, region, source_type, language_hint FROM enriched",
    ),
    "article_id": query(
        entry_ids,
        _ENTRIES + "SELECT article_id, feed_id, link AS source_url, title FROM identified",
    ),
    "published_at": query(published, _ENTRIES + "SELECT page_id, title, published_at FROM entries"),
    "entry_body": query(
        bodies, _ENTRIES + "SELECT page_id, title, coalesce(link, id, '') AS link, body FROM entries"
    ),
    "stage_records": query(
        records,
        _ENTRIES
        + "SELECT article_id, feed_id, region, source_type, coalesce(link, id, '') AS source_url, "
        "title, summary, body, strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at, "
        f"language_hint, '{a.RUN_TS}' AS ingested_at, DATE '{a.RUN_DATE}' AS ingestion_date, "
        f"{_PAYLOAD} AS raw_payload FROM identified",
    ),
    "staging_scan": query(staging_scan, _STAGED_TEXT),
    "latest_batch": query(
        newest_batch,
        _STAGED_TEXT
        + " WHERE ingestion_date = (SELECT max(ingestion_date) FROM articles)",
    ),
    "date_slice": query(
        one_date,
        with_ctes(
            "articles",
            select=f"SELECT {BRONZE_COLUMNS} FROM articles WHERE ingestion_date = DATE '2025-01-02'",
        ),
    ),
    "bronze_load": query(
        bronze_load,
        with_ctes(
            "articles",
            select="SELECT * EXCLUDE (doc_id) REPLACE ("
            f"CASE WHEN doc_id % 2 = 0 THEN ingestion_date ELSE DATE '{a.RUN_DATE}' END "
            "AS ingestion_date, "
            "CASE WHEN doc_id % 6 <> 0 THEN published_at END AS published_at) FROM articles",
        ),
    ),
    "bronze_dedup": query(
        bronze_dedup, with_ctes("bronze_dup", select=f"SELECT {BRONZE_COLUMNS} FROM bronze_dup")
    ),
}
