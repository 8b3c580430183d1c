"""Cleaned articles: one row per distinct content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions import text
from feedlake.operators.dedup import keep_first
from feedlake.profiles import CLUSTER, Profile


def pick_content(profile: Profile = CLUSTER) -> Column:
    return text.first_present(
        F.col("body"), F.col("summary"), F.col("title"), skip_empty=profile.skip_empty_fields
    )


def article_metadata() -> Column:
    return F.create_map(F.lit("feed_id"), F.col("feed_id"), F.lit("region"), F.col("region"))


def clean_articles(
    bronze: DataFrame, profile: Profile = CLUSTER, as_of: Column | None = None
) -> DataFrame:
    """Cleaned title and content, hash, language and metadata; short articles are dropped."""
    content = text.normalize_text(pick_content(profile), profile.unicode_text)
    title = text.normalize_text(F.coalesce(F.col("title"), F.lit("")), profile.unicode_text)
    # A filter on the content would be pushed below the step that makes it and
    # clean every text twice; exploding a list of one or none is not.
    kept = F.filter(
        F.array(content),
        lambda c: text.long_enough(c, profile.min_chars, profile.min_chars_inclusive),
    )
    return (
        bronze.select("*", F.explode(kept).alias("content"))
        .select(
            "article_id",
            "feed_id",
            "region",
            title.alias("title"),
            "content",
            text.content_hash(
                F.col("content"), profile.case_sensitive_hash, blanks_only=True
            ).alias("content_hash"),
            text.language_tag(F.col("language_hint"), profile.empty_hint_is_unknown).alias(
                "language"
            ),
            "published_at",
            "source_url",
            article_metadata().alias("metadata"),
            (F.current_timestamp() if as_of is None else as_of).alias("processed_at"),
            "ingestion_date",
            "ingested_at",
            *[c for c in bronze.columns if c == "ordinal"],
        )
    )


def dedup_latest(cleaned: DataFrame) -> DataFrame:
    """Per content and date the article ingested last; ties go to the smallest id."""
    order = [F.col("ingested_at").desc(), F.col("article_id").asc()]
    return keep_first(cleaned, ["content_hash", "ingestion_date"], order)


def dedup_first(cleaned: DataFrame, ordinal: list[str]) -> DataFrame:
    """Per content the first article in input order, whatever its date."""
    return keep_first(cleaned, ["content_hash"], [F.col(c) for c in ordinal])


def build_silver(
    bronze: DataFrame, profile: Profile = CLUSTER, as_of: Column | None = None
) -> DataFrame:
    """Bronze to silver.

    Without per-date dedup the first copy in input order stays. That order is the column
    ``ordinal`` if there is one, else time of ingestion, then id.
    """
    cleaned = clean_articles(bronze, profile, as_of)
    if profile.dedup_per_date:
        kept = dedup_latest(cleaned)
    else:
        placed = "ordinal" in cleaned.columns
        kept = dedup_first(cleaned, ["ordinal"] if placed else ["ingested_at", "article_id"])
    return kept.drop("ingested_at", "ordinal")
