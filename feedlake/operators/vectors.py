"""The vector table: which chunks are due, their records, and the embedding job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import fixed, schemas
from feedlake.functions.vectors import namespace, vector_metadata
from feedlake.operators.dedup import keep_first
from feedlake.operators.embed import ModelFactory, embed_text, hashed_words
from feedlake.operators.order import running_before
from feedlake.session import broadcast_if_small, discard, materialize
from feedlake.sources.tables import append_table, create_table, date_slice, in_partitions, read_table
from feedlake.sources.versions import VersionedTable, name_at

VECTOR_KEY = ["namespace", "id"]
STAMP_KEY = ["chunk_id", "ingestion_date", "region"]


def pending_chunks(gold: DataFrame, date: str | None = None) -> DataFrame:
    """Chunks not embedded yet, of one date where one is given."""
    return date_slice(gold.filter(F.col("embedded_at").isNull()), date)


def pending_batch(
    gold: DataFrame, date: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """The chunks one run takes: all that are due, or the oldest ``max_rows`` of them."""
    pending = pending_chunks(gold, date)
    if max_rows is None:
        return pending
    return pending.orderBy("ingestion_date", "chunk_id").limit(max_rows)


def batch_numbers(rows: DataFrame, size: int = fixed.UPSERT_BATCH) -> DataFrame:
    """Number the batches of a run, oldest date first."""
    placed = running_before(rows, ["ingestion_date", "chunk_id"], F.lit(1), "_place")
    return placed.withColumn("batch_index", F.floor(F.col("_place") / size).cast("int")).drop("_place")


def vector_records(
    chunks: DataFrame, factory: ModelFactory = hashed_words, extra: dict[str, Column] | None = None
) -> DataFrame:
    """Records of the vector table for gold rows: namespace, id, values, language, metadata."""
    return chunks.select(
        namespace(F.col("region")).alias("namespace"),
        F.col("chunk_id").alias("id"),
        embed_text(F.col("chunk_text"), factory).alias("values"),
        "language",
        vector_metadata(extra).alias("metadata"),
    )


def upsert_counts(records: DataFrame, *by: str) -> DataFrame:
    """Rows sent per namespace, and per further columns where given."""
    return records.groupBy(*by, "namespace").agg(F.count(F.lit(1)).alias("n_vectors"))


def vector_table(spark: SparkSession, path: str, buckets: int = schemas.VECTOR_BUCKETS) -> VersionedTable:
    """The vectors at a folder: one per namespace and id, in buckets of ids, switched as a whole."""
    return VersionedTable(
        spark, name_at(path), path, schemas.VECTORS, tuple(schemas.VECTOR_PARTITIONS), ("id",), buckets
    ).create()


def upsert_vectors(table: VersionedTable, records: DataFrame, order: list[Column] | None = None) -> None:
    """Put vectors in by namespace and id. Of several records of one key the first by `order` stays,
    then the one whose metadata and values come first."""
    ties = [F.col("metadata").asc_nulls_last(), F.col("values")]
    table.upsert(records, VECTOR_KEY, [*(order or []), *ties])


def stamps_path(gold_path: str) -> str:
    """Where the stamps of a gold table lie: narrow rows of their own, so that a stamp moves no text."""
    return f"{gold_path.rstrip('/')}_stamps"


def read_stamps(spark: SparkSession, gold_path: str) -> DataFrame:
    """(chunk_id, embedded_at, ingestion_date, region) of every chunk embedded, perhaps repeatedly."""
    path = stamps_path(gold_path)
    create_table(spark, path, schemas.STAMPS, schemas.GOLD_PARTITIONS)
    return read_table(spark, path, schemas.STAMPS)


def read_gold(spark: SparkSession, gold_path: str, date: str | None = None) -> DataFrame:
    """The gold table with ``embedded_at`` as the stamps have it."""
    gold = read_table(spark, gold_path, schemas.GOLD, date)
    newest = date_slice(read_stamps(spark, gold_path), date).groupBy(*STAMP_KEY).agg(F.max("embedded_at").alias("_stamp"))
    stamped = gold.join(newest, STAMP_KEY, "left").withColumn("embedded_at", F.coalesce("_stamp", "embedded_at"))
    return stamped.select(*gold.columns)


def due_chunks(
    gold: DataFrame, stamps: DataFrame, date: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """(chunk_id, ingestion_date, region) of the chunks without a stamp, or of the oldest ``max_rows``.

    Neither side's texts are read.
    """
    unmarked = date_slice(gold.filter(F.col("embedded_at").isNull()), date).select(*STAMP_KEY)
    due = unmarked.join(date_slice(stamps, date).select(*STAMP_KEY), STAMP_KEY, "left_anti")
    if max_rows is None:
        return due
    return due.orderBy("ingestion_date", "chunk_id", "region").limit(max_rows)


def newest_of_key(due: DataFrame, stamps: DataFrame) -> DataFrame:
    """Of the due chunks the one of each vector's newest date, if no newer one is embedded already."""
    keyed = due.withColumn("namespace", namespace(F.col("region")))
    first = keep_first(keyed, ["namespace", "chunk_id"], [F.col("ingestion_date").desc(), F.col("region")])
    held = stamps.groupBy(namespace(F.col("region")).alias("namespace"), "chunk_id").agg(
        F.max("ingestion_date").alias("_held")
    )
    open_rows = first.join(held, ["namespace", "chunk_id"], "left")
    return open_rows.filter("_held IS NULL OR _held <= ingestion_date").select(*STAMP_KEY)


def run_embedding(
    spark: SparkSession, gold_path: str, vector_path: str, embedded_at: Column,
    date: str | None = None, factory: ModelFactory = hashed_words,
    max_rows: int | None = None,
) -> DataFrame:
    """Embed what is due, upsert the vectors, then stamp the chunks; returns counts per namespace.

    A chunk that is due, or embedded, on several dates has one vector, that of the newest
    date; all its dates are stamped. Only the texts of chunks to embed are read, and a stamp
    is a row of its own table: gold is not written. The stamps come after the switch to the
    new vectors. A run that fails before is repeated by the next one, which replaces the
    same vectors.
    """
    gold, stamps = read_table(spark, gold_path, schemas.GOLD), read_stamps(spark, gold_path)
    due = materialize(due_chunks(gold, stamps, date, max_rows), "due")
    wanted = materialize(newest_of_key(due, stamps), "wanted")
    near = in_partitions(gold, wanted, schemas.GOLD_PARTITIONS)
    batch = near.join(broadcast_if_small(wanted), STAMP_KEY, "left_semi")
    batch = keep_first(batch, STAMP_KEY, [F.col("chunk_text"), F.col("article_id"), F.col("chunk_index")])
    records = materialize(vector_records(batch, factory), "vectors")
    upsert_vectors(vector_table(spark, vector_path), records)
    done = due.withColumn("embedded_at", embedded_at).select(*schemas.STAMPS.fieldNames())
    append_table(done, stamps_path(gold_path), schemas.GOLD_PARTITIONS)
    counts = materialize(upsert_counts(records), "counts")
    discard(due, wanted, records)
    return counts
