"""Raw articles: typed staging records, one per article and date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake import schemas
from feedlake.operators.dedup import keep_first

KEY = ["article_id", "ingestion_date"]


def load_bronze(staged: DataFrame, run_date: str | None = None) -> DataFrame:
    """Staging records with the bronze columns and types.

    Times that cannot be read become NULL. A missing ``ingestion_date`` becomes
    ``run_date``. A payload that is still nested is written as JSON text. A column
    ``ordinal``, the place in the input, stays if there is one.
    """
    default_date = F.to_date(F.lit(run_date or None).cast("string"))
    payload = F.col("raw_payload")
    if isinstance(staged.schema["raw_payload"].dataType, StructType):
        payload = F.to_json(payload)
    changed = {
        "published_at": F.try_to_timestamp(F.col("published_at")),
        "ingested_at": F.try_to_timestamp(F.col("ingested_at")),
        "raw_payload": payload,
        "ingestion_date": F.coalesce(F.col("ingestion_date"), default_date),
    }
    place = [c for c in staged.columns if c == "ordinal"]
    return staged.select(
        *[changed.get(c, F.col(c)).alias(c) for c in schemas.BRONZE.fieldNames()], *place
    )


def newest_first() -> list[Column]:
    """Latest ingestion first; then by content, so that the choice is always the same."""
    rest = [c for c in schemas.BRONZE.fieldNames() if c not in (*KEY, "ingested_at")]
    ties = [F.col(c).asc_nulls_last() for c in rest]
    return [F.col("ingested_at").desc_nulls_last(), *ties]


def dedup_bronze(bronze: DataFrame) -> DataFrame:
    """One row per article and date: the one ingested last."""
    return keep_first(bronze, KEY, newest_first())


def build_bronze(staged: DataFrame, run_date: str | None = None) -> DataFrame:
    return dedup_bronze(load_bronze(staged, run_date))
