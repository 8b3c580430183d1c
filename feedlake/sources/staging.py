"""Staged batches: JSON lines, one folder per run under its date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedlake import schemas

FILES = "*.json*"


def write_staging(records: DataFrame, root: str, run_date: str, run_id: str) -> str:
    """Write one run's records to ``root/YYYY/MM/DD/batch_<run_id>``; returns that folder.

    Files are compressed: summary and body often say the same. A run written again replaces itself.
    """
    folder = f"{root}/{run_date.replace('-', '/')}/batch_{run_id}"
    records.write.mode("overwrite").json(folder, compression="gzip", ignoreNullFields=False)
    return folder


def read_staging(
    spark: SparkSession, path: str, corrupt_column: str | None = None, ordinal: str | None = None
) -> DataFrame:
    """All records under a folder, with a declared schema: nothing is read twice to infer one.

    ``corrupt_column`` keeps lines that are no JSON, as text, in that column. ``ordinal``
    names a column with each record's place in the input: its file, the start of the
    block it was read in, and its place there. It orders records as the files hold them.
    """
    reader = spark.read.schema(schemas.STAGING)
    if corrupt_column:
        fields = [*schemas.STAGING.fields, StructField(corrupt_column, StringType())]
        reader = reader.schema(StructType(fields)).option(
            "columnNameOfCorruptRecord", corrupt_column
        )
    reader = reader.option("recursiveFileLookup", "true")
    rows = reader.option("pathGlobFilter", FILES).json(path)
    if ordinal is None:
        return rows
    # Ids grow within a task, which reads its blocks from start to end.
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return rows.withColumn(ordinal, place)


def latest_batch(spark: SparkSession, root: str) -> str:
    """The folder of the run that holds the newest file; ties go to the greatest path.

    Only file names and times are listed, no content is read.
    """
    newest = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", FILES)
        .load(root)
        .select("path", "modificationTime")
        .orderBy(F.desc("modificationTime"), F.desc("path"))
        .first()
    )
    if newest is None:
        raise FileNotFoundError(f"no staged file under {root}")
    return newest["path"].rsplit("/", 1)[0]
