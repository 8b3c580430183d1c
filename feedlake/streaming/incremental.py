"""New staged files into the bronze table, as streams that stop when they have caught up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators.bronze import KEY, load_bronze, newest_first
from feedlake.operators.medallion import load_records
from feedlake.operators.upsert import same_keys
from feedlake.profiles import CLUSTER, Profile
from feedlake.session import discard, materialize
from feedlake.sources.staging import FILES
from feedlake.sources.tables import upsert_table


def staged_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(schemas.STAGING)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", FILES)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(root)


def append_new(
    spark: SparkSession, staging_root: str, bronze_path: str, checkpoint: str,
    run_date: str | None = None, files_per_batch: int | None = None,
) -> None:
    """Append the records of files not seen before, each file once."""
    bronze = load_bronze(staged_stream(spark, staging_root, files_per_batch), run_date)
    query = (
        bronze.writeStream.format("parquet")
        .partitionBy(*schemas.BRONZE_PARTITIONS)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(bronze_path)
    )
    query.awaitTermination()


def upsert_new(
    spark: SparkSession, staging_root: str, bronze_path: str, checkpoint: str,
    run_date: str | None = None, files_per_batch: int | None = None,
) -> None:
    """Keep per article and date the newest record of all files, in whatever order they come.

    A micro-batch that is run again after a failure gives the same table. Its files stay, so they
    are read again rather than copied.
    """

    def merge(batch: DataFrame, _: int) -> None:
        upsert_table(
            batch.sparkSession, bronze_path, batch, KEY, schemas.BRONZE_PARTITIONS,
            newest_first(), newest=True, written=True,
        )

    query = (
        load_bronze(staged_stream(spark, staging_root, files_per_batch), run_date)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def newest(bronze: DataFrame, delay: str = "2 days") -> DataFrame:
    """Stream dedup with bounded state: the newest record of a key so far, each time it changes.

    A key's records are those of one ingestion date. The state holds keys whose date is less
    than ``delay`` behind the newest one; a record that comes later than that is dropped. Ties
    are decided as in the batch, so the order of arrival does not matter. The order names every
    column, so a record is held once, as its place in that order.
    """
    columns = schemas.BRONZE.fieldNames()
    order = [F.col("ingested_at").isNull().alias("_0"), (-F.unix_micros("ingested_at")).alias("ingested_at")]
    for i, c in enumerate(columns, 1):
        if c not in (*KEY, "ingested_at"):
            order += [F.col(c).isNull().alias(f"_{i}"), F.col(c).alias(c)]
    dated = bronze.withColumn("_day", F.col("ingestion_date").cast("timestamp")).withWatermark("_day", delay)
    first = dated.groupBy(*KEY, "_day").agg(F.min(F.struct(*order)).alias("r"))
    made = {"ingested_at": F.timestamp_micros(-F.col("r.ingested_at")), **{c: F.col(c) for c in KEY}}
    return first.select(*[made.get(c, F.col(f"r.{c}")).alias(c) for c in columns])


def newest_times(bronze: DataFrame, delay: str = "2 days") -> DataFrame:
    """The state of ``newest`` without the records: when a key's newest record was ingested, as
    ``_at``, whose least value is the newest."""
    at = F.struct(F.col("ingested_at").isNull().alias("_0"), (-F.unix_micros("ingested_at")).alias("_1"))
    dated = bronze.withColumn("_day", F.col("ingestion_date").cast("timestamp")).withWatermark("_day", delay)
    return dated.groupBy(*KEY, "_day").agg(F.min(at).alias("_at")).drop("_day")


def with_newest_times(bronze: DataFrame, delay: str = "2 days") -> DataFrame:
    """The records, and rows that hold nothing but a key and its ``newest_times``."""
    rows = bronze.withColumn("_at", F.lit(None).cast("struct<_0:boolean,_1:bigint>"))
    return rows.unionByName(newest_times(bronze, delay), allowMissingColumns=True)


def of_newest_times(batch: DataFrame) -> DataFrame:
    """The records of a batch of ``with_newest_times`` that are as new as their key's newest."""
    times = batch.filter(F.col("_at").isNotNull()).select(*KEY, "_at")
    rows = batch.filter(F.col("_at").isNull()).drop("_at")
    late = F.col("ingested_at").isNull()
    same = same_keys(rows, times, KEY) & (times["_at._0"] == late) & times["_at._1"].eqNullSafe(-F.unix_micros("ingested_at"))
    return rows.join(times, same, "left_semi")


def upsert_latest(
    spark: SparkSession, staging_root: str, bronze_path: str, checkpoint: str,
    run_date: str | None = None, files_per_batch: int | None = None, delay: str = "2 days",
) -> None:
    """Like ``upsert_new``, out of the stream's own state: only records that are the newest of
    their key so far reach the table. Run again after a failure, a micro-batch changes nothing.

    The state holds keys and times, no texts. Of records of one key and time the table keeps the
    first by the batch's order, so the order of arrival does not matter."""

    def merge(batch: DataFrame, _: int) -> None:
        written = materialize(batch, "batch")
        upsert_table(
            batch.sparkSession, bronze_path, of_newest_times(written), KEY, schemas.BRONZE_PARTITIONS,
            newest_first(), newest=True, written=True,
        )
        discard(written)

    query = (
        with_newest_times(load_bronze(staged_stream(spark, staging_root, files_per_batch), run_date), delay)
        .writeStream.outputMode("update").foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_medallion(
    spark: SparkSession, staging_root: str, root: str, checkpoint: str,
    run_date: str | None = None, profile: Profile = CLUSTER, as_of: Column | None = None,
    vector_path: str | None = None, files_per_batch: int | None = None,
) -> None:
    """Carry the records of new files through bronze, silver and gold, and out of the vectors.

    Each micro-batch builds the dates it touches anew, so the tables are those of one run
    over all files, and a micro-batch that is run again changes nothing. Its files stay, so they
    are read again rather than copied.
    """

    def load(batch: DataFrame, _: int) -> None:
        load_records(
            batch.sparkSession, batch, root, profile, as_of, vector_path=vector_path, staged=True
        )

    query = (
        load_bronze(staged_stream(spark, staging_root, files_per_batch), run_date)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def first_seen(bronze: DataFrame, delay: str = "2 days") -> DataFrame:
    """Stream dedup with bounded state: the first record of a key stays, not the newest."""
    return bronze.withWatermark("ingested_at", delay).dropDuplicatesWithinWatermark(KEY)
