"""Table schemas. Nullability is a contract that `operators.contracts` checks."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DataType, DateType, DoubleType, IntegerType, MapType, StringType, StructField,
    StructType, TimestampType,
)

TEXT, INT, DATE, TIME = StringType(), IntegerType(), DateType(), TimestampType()
TAGS, VECTOR = MapType(TEXT, TEXT), ArrayType(DoubleType())


def _schema(**columns: DataType | tuple[DataType, str]) -> StructType:
    """Columns by name; a pair with "required" marks one that must not be NULL."""
    return StructType(
        [
            StructField(name, kind[0], False) if isinstance(kind, tuple)
            else StructField(name, kind, True)
            for name, kind in columns.items()
        ]
    )


TEXT_REQUIRED, INT_REQUIRED = (TEXT, "required"), (INT, "required")
DATE_REQUIRED, TIME_REQUIRED = (DATE, "required"), (TIME, "required")

FEEDS = _schema(
    feed_id=TEXT_REQUIRED,
    region=TEXT_REQUIRED,
    language_hint=TEXT,
    source_type=TEXT_REQUIRED,
    url=TEXT,
    poll_interval_minutes=INT,
)

# One JSON object per line. Times are text, and the payload stays the text it was.
STAGING = _schema(
    article_id=TEXT,
    feed_id=TEXT,
    region=TEXT,
    source_type=TEXT,
    source_url=TEXT,
    title=TEXT,
    summary=TEXT,
    body=TEXT,
    published_at=TEXT,
    language_hint=TEXT,
    raw_payload=TEXT,
    ingested_at=TEXT,
    ingestion_date=DATE,
)

BRONZE = _schema(
    article_id=TEXT_REQUIRED,
    feed_id=TEXT_REQUIRED,
    region=TEXT_REQUIRED,
    source_type=TEXT_REQUIRED,
    source_url=TEXT,
    title=TEXT,
    summary=TEXT,
    body=TEXT,
    published_at=TIME,
    language_hint=TEXT,
    raw_payload=TEXT,
    ingested_at=TIME_REQUIRED,
    ingestion_date=DATE_REQUIRED,
)

SILVER = _schema(
    article_id=TEXT_REQUIRED,
    feed_id=TEXT_REQUIRED,
    region=TEXT_REQUIRED,
    title=TEXT_REQUIRED,
    content=TEXT_REQUIRED,
    content_hash=TEXT_REQUIRED,
    language=TEXT_REQUIRED,
    published_at=TIME,
    source_url=TEXT,
    metadata=TAGS,
    processed_at=TIME_REQUIRED,
    ingestion_date=DATE_REQUIRED,
)

# Which records have a content: what copies are found by, without texts.
CONTENTS = _schema(
    article_id=TEXT_REQUIRED,
    ingestion_date=DATE_REQUIRED,
    region=TEXT,
    language=TEXT,
    content_hash=TEXT_REQUIRED,
    ingested_at=TIME,
    shard=TEXT_REQUIRED,
)

GOLD = _schema(
    chunk_id=TEXT_REQUIRED,
    article_id=TEXT_REQUIRED,
    feed_id=TEXT_REQUIRED,
    region=TEXT_REQUIRED,
    language=TEXT_REQUIRED,
    chunk_index=INT_REQUIRED,
    chunk_text=TEXT_REQUIRED,
    token_count=INT_REQUIRED,
    published_at=TIME,
    source_url=TEXT,
    metadata=TAGS,
    created_at=TIME_REQUIRED,
    ingestion_date=DATE_REQUIRED,
    embedded_at=TIME,
)

# That a chunk has been embedded: beside gold, so that no text is moved for it.
STAMPS = _schema(
    chunk_id=TEXT_REQUIRED,
    embedded_at=TIME,
    ingestion_date=DATE_REQUIRED,
    region=TEXT_REQUIRED,
)

VECTORS = _schema(
    namespace=TEXT_REQUIRED,
    id=TEXT_REQUIRED,
    values=(VECTOR, "required"),
    language=TEXT,
    metadata=TEXT,
)

BRONZE_PARTITIONS = ["ingestion_date", "region"]
SILVER_PARTITIONS = ["ingestion_date", "language"]
GOLD_PARTITIONS = ["ingestion_date", "region"]
VECTOR_PARTITIONS = ["namespace"]
VECTOR_BUCKETS = 8  # of ids; a table of billions asks for thousands
