"""Appends, upserts, stamps and contracts."""

from __future__ import annotations

import contextlib
import dataclasses
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators.contracts import split_by_contract, split_references
from feedlake.operators.upsert import append_evolve, mark_embedded, upsert
from feedlake.operators.vectors import STAMP_KEY, upsert_vectors, vector_table
from feedlake.plans import adapters as a
from feedlake.plans.registry import query
from feedlake.plans.sql import BRONZE_COLUMNS, with_ctes
from feedlake.session import materialize, shared_dir
from feedlake.sources.feeds import usable_feeds
from feedlake.sources.tables import append_table, read_table, upsert_table
from feedlake.sources.versions import VersionedTable, name_at

STAMP = "2025-02-02 00:00:00"


def evolved(spark: SparkSession, d: str) -> DataFrame:
    """Appended twice, the second time with another column: the rows stay double."""
    path = shared_dir(spark, "evolve")
    rows = a.articles(spark, d).select("article_id", "title", "region", "ingestion_date")
    append_table(rows, path, ["ingestion_date"])
    append_table(rows.withColumn("note", F.upper("region")), path, ["ingestion_date"])
    return read_table(spark, path)


def evolved_frames(spark: SparkSession, d: str) -> DataFrame:
    rows = a.articles(spark, d).select("article_id", "title")
    return append_evolve(rows, rows.withColumn("note", F.concat(F.lit("re "), "title")))


def upserted_articles(spark: SparkSession, d: str) -> DataFrame:
    """The late copies replace their originals; each comes twice, the longer title wins."""
    base = a.articles(spark, d).drop("doc_id")
    late = a.late_copies(base)
    source = late.unionByName(late.withColumn("title", F.concat("title", F.lit("!"))))
    return upsert(base, source, ["article_id"], [F.length("title").desc()])


def upserted_chunks(spark: SparkSession, d: str) -> DataFrame:
    """French chunks change their text and move to the next date; German ones get copies."""
    path = shared_dir(spark, "gold")
    gold = a.gold(spark, d)
    append_table(gold, path, schemas.GOLD_PARTITIONS)
    table = read_table(spark, path, schemas.GOLD)
    moved = (
        table.filter(F.col("language") == "fr")
        .withColumn("chunk_text", F.upper("chunk_text"))
        .withColumn("ingestion_date", F.date_add("ingestion_date", 1))
    )
    new = table.filter(F.col("language") == "de").withColumn(
        "chunk_id", F.concat(F.lit("n_"), "chunk_id")
    )
    upsert_table(spark, path, moved.unionByName(new), ["chunk_id"], schemas.GOLD_PARTITIONS)
    return read_table(spark, path, schemas.GOLD).select(
        "chunk_id", "article_id", "chunk_text", "ingestion_date", "region"
    )


def marked(spark: SparkSession, d: str) -> DataFrame:
    gold = a.half_embedded(a.gold(spark, d))
    done = gold.filter(F.col("language") == "en").select(
        "chunk_id", F.lit(STAMP).cast("timestamp").alias("embedded_at")
    )
    return mark_embedded(gold, done).select("chunk_id", "language", "embedded_at")


def _vector_rows(spark: SparkSession, d: str) -> DataFrame:
    return a.vectors(spark, d).select(
        "namespace", "id", F.col("values").cast("array<double>").alias("values"), "language",
        F.lit(None).cast("string").alias("metadata"),
    )


def upserted_vectors(spark: SparkSession, d: str) -> DataFrame:
    """German vectors are replaced twice in one source, where the later negatives win over the
    earlier doubles; Spanish ones also enter the next namespace. Every value of every vector."""
    table = vector_table(spark, shared_dir(spark, "vectors"))
    vectors = _vector_rows(spark, d)
    upsert_vectors(table, vectors)
    german = vectors.filter(F.col("language") == "de")
    doubled = german.withColumns({"values": F.transform("values", lambda x: x * 2), "day": F.lit(1)})
    negated = german.withColumns({"values": F.transform("values", lambda x: -x), "day": F.lit(2)})
    copied = vectors.filter(F.col("language") == "es").withColumns({"namespace": F.lit("apac"), "day": F.lit(1)})
    upsert_vectors(table, negated.unionByName(doubled).unionByName(copied), [F.col("day").desc()])
    return table.read().select("namespace", "id", "language", F.posexplode("values").alias("pos", "x")).withColumn(
        "x", F.round("x", 6)
    )


def switched(spark: SparkSession, d: str) -> DataFrame:
    """What readers of a table see around a switch: opened before it, in a run that ended before it, after
    it, and after old versions have gone."""
    path = shared_dir(spark, "switch")
    table = VersionedTable(
        spark, name_at(path), path, schemas.GOLD, tuple(schemas.GOLD_PARTITIONS), ("chunk_id",), schemas.VECTOR_BUCKETS
    ).create()
    gold = materialize(a.gold(spark, d), "gold")
    table.switch(gold, gold)
    before = table.read()
    german = gold.filter(F.col("language") == "de").withColumn("chunk_text", F.upper("chunk_text"))
    with contextlib.suppress(_Ended):
        _EndsEarly(*[getattr(table, f.name) for f in dataclasses.fields(table)]).upsert(german, STAMP_KEY, [F.col("chunk_text")])
    ended = table.read()

    def seen(rows: DataFrame, reader: str) -> DataFrame:
        counted = rows.groupBy("ingestion_date", "region").agg(
            F.count(F.lit(1)).alias("n_chunks"), F.sum(F.conv(F.substring(F.md5("chunk_text"), 1, 8), 16, 10).cast("long")).alias("digest")
        )
        return materialize(counted.select(F.lit(reader).alias("reader"), "*"), "seen")

    seen_ended = seen(ended, "ended")
    table.upsert(german, STAMP_KEY, [F.col("chunk_text")])
    views = [seen(before, "before"), seen_ended, seen(table.read(), "after")]
    table.drop_versions(keep=1)
    views.append(seen(table.read(), "cleaned"))
    return functools.reduce(DataFrame.unionByName, views)


class _Ended(Exception):
    pass


class _EndsEarly(VersionedTable):
    """A writer that ends between its files and the switch."""

    def _show(self, table: str) -> None:
        raise _Ended


def violations(spark: SparkSession, d: str) -> DataFrame:
    """Articles in which required columns go missing, by source."""
    n = F.col("doc_id")
    dirty = a.articles(spark, d).withColumns(
        {
            "region": F.when(n % 3 != 0, F.col("region")),
            "article_id": F.when(n % 4 != 0, F.col("article_id")),
            "ingested_at": F.when(n % 5 != 0, F.col("ingested_at")),
        }
    )
    _, broken = split_by_contract(dirty, schemas.BRONZE)
    return broken.select("doc_id", F.array_join("violations", ",").alias("violations"))


def broken_sets(spark: SparkSession, d: str) -> DataFrame:
    """Feeds of one region are registered twice; their articles have no usable feed, and their chunks no article."""
    feeds = a.feeds(spark, d)
    usable, repeated = usable_feeds(feeds.unionByName(feeds.filter("region = 'emea'")))
    known, orphans = split_references(a.articles(spark, d), ["feed_id"], usable)
    _, lost = split_references(a.gold(spark, d), ["article_id"], known)

    def shown(rows: DataFrame, kind: str, key: str) -> DataFrame:
        return rows.groupBy(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.array_join("violations", ",").alias("violations")).agg(
            F.count(F.lit(1)).alias("n_rows")
        )

    parts = (shown(repeated, "feed", "feed_id"), shown(orphans, "article", "article_id"), shown(lost, "chunk", "chunk_id"))
    return functools.reduce(DataFrame.unionByName, parts)


QUERIES = {
    "append_evolve": query(
        evolved,
        with_ctes(
            "articles",
            select="SELECT article_id, title, region, ingestion_date, NULL::VARCHAR AS note "
            "FROM articles UNION ALL SELECT article_id, title, region, ingestion_date, "
            "upper(region) FROM articles",
        ),
    ),
    "append_evolve_frames": query(
        evolved_frames,
        with_ctes(
            "articles",
            select="SELECT article_id, title, NULL::VARCHAR AS note FROM articles "
            "UNION ALL SELECT article_id, title, 're ' || title FROM articles",
        ),
    ),
    "upsert_articles": query(
        upserted_articles,
        with_ctes(
            "late_copies",
            select=f"SELECT {BRONZE_COLUMNS} FROM articles WHERE article_id NOT IN "
            "(SELECT article_id FROM late_copies) UNION ALL "
            f"SELECT {BRONZE_COLUMNS.replace('title', 'title || chr(33)')} FROM late_copies",
        ),
    ),
    "upsert_chunks": query(
        upserted_chunks,
        with_ctes(
            "gold",
            select="SELECT chunk_id, article_id, CASE WHEN language = 'fr' THEN upper(chunk_text) "
            "ELSE chunk_text END AS chunk_text, CASE WHEN language = 'fr' THEN ingestion_date + 1 "
            "ELSE ingestion_date END AS ingestion_date, region FROM gold UNION ALL "
            "SELECT 'n_' || chunk_id, article_id, chunk_text, ingestion_date, region FROM gold "
            "WHERE language = 'de'",
        ),
    ),
    "mark_embedded": query(
        marked,
        with_ctes(
            "half_embedded",
            select=f"SELECT chunk_id, language, CASE WHEN language = 'en' THEN TIMESTAMP '{STAMP}' "
            "ELSE embedded_at END AS embedded_at FROM half_embedded",
        ),
    ),
    "vector_upsert": query(
        upserted_vectors,
        with_ctes(
            "vectors",
            select="SELECT namespace, id, language, pos::INTEGER AS pos, round(x, 6) AS x FROM ("
            "SELECT namespace, id, language, unnest(range(0, len(vals))) AS pos, "
            "unnest(CASE WHEN language = 'de' THEN list_transform(vals, lambda v: -v) ELSE vals END) AS x FROM vectors "
            "UNION ALL SELECT 'apac', id, language, unnest(range(0, len(vals))), unnest(vals) "
            "FROM vectors WHERE language = 'es')",
        ),
    ),
    "version_switch": query(
        switched,
        with_ctes(
            "gold",
            select="""
    SELECT reader, ingestion_date, region, count(*) AS n_chunks, sum(crc)::BIGINT AS digest FROM (
      SELECT r.reader, ingestion_date, region,
             ('0x' || substr(md5(CASE WHEN language = 'de' AND r.reader IN ('after', 'cleaned')
                                      THEN upper(chunk_text) ELSE chunk_text END), 1, 8))::BIGINT AS crc
      FROM gold, (VALUES ('before'), ('ended'), ('after'), ('cleaned')) r(reader))
    GROUP BY ALL""",
        ),
    ),
    "contract_sets": query(
        broken_sets,
        with_ctes(
            "gold",
            select="SELECT 'feed' AS kind, feed_id AS id, 'repeated: feed_id' AS violations, 2 AS n_rows "
            "FROM articles WHERE region = 'emea' GROUP BY feed_id UNION ALL "
            "SELECT 'article', article_id, 'unknown: feed_id', count(*) FROM articles WHERE region = 'emea' GROUP BY article_id "
            "UNION ALL SELECT 'chunk', chunk_id, 'unknown: article_id', count(*) FROM gold WHERE region = 'emea' GROUP BY chunk_id",
        ),
    ),
    "contract_violations": query(
        violations,
        "SELECT doc_id, concat_ws(',', CASE WHEN doc_id % 4 = 0 THEN 'article_id' END, "
        "CASE WHEN doc_id % 3 = 0 THEN 'region' END, "
        "CASE WHEN doc_id % 5 = 0 THEN 'ingested_at' END) AS violations FROM documents "
        "WHERE doc_id % 3 = 0 OR doc_id % 4 = 0 OR doc_id % 5 = 0",
    ),
}
