"""The feed registry, a small dimension table, and its join to entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.feeds import article_id, entry_link, iso_text, published_at
from feedlake.functions.vectors import json_object
from feedlake.operators.contracts import split_by_contract, split_unique
from feedlake.session import broadcast_if_small


def read_feeds(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schemas.FEEDS).format(fmt).load(path)


def usable_feeds(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feeds with all that is required and an id of their own, and the others with column ``violations``.

    A registry with two feeds of one id would give every entry of it twice.
    """
    whole, lacking = split_by_contract(feeds, schemas.FEEDS)
    good, repeated = split_unique(whole, ["feed_id"])
    return good, lacking.unionByName(repeated)


def attach_feeds(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Give each entry its feed's region, source type and language hint.

    One feed may hold most entries; the registry is broadcast once counted, so
    entries are not shuffled.
    """
    attributes = feeds.select("feed_id", "region", "source_type", "language_hint")
    return entries.join(broadcast_if_small(attributes), "feed_id")


def stage_records(
    entries: DataFrame, run_ts: str, run_date: str, url_fallback: bool = False,
    keep_published: bool = True,
) -> DataFrame:
    """The staging record of each entry that has its feed's attributes.

    With ``url_fallback`` an absent link is replaced by the entry's id, as in
    the identity; otherwise the link stays as it is. A run has one timestamp
    and one date. The payload is the whole entry as JSON.
    """
    link, entry_id = F.col("link"), F.col("id")
    published = iso_text(published_at(F.col("published"), F.col("updated")))
    lists = {
        k: F.when(F.size(k) > 0, F.col(k))
        for k in ("contents", "authors", "tags", "enclosures") if k in entries.columns
    }
    payload = json_object(
        {k: F.col(k) for k in ("title", "link", "id", "published", "updated", "summary", "body")}
        | lists
    )
    return entries.select(
        article_id(F.col("feed_id"), link, entry_id).alias("article_id"),
        "feed_id",
        "region",
        "source_type",
        (entry_link(link, entry_id) if url_fallback else link).alias("source_url"),
        "title",
        "summary",
        "body",
        (published if keep_published else F.lit(None).cast("string")).alias("published_at"),
        "language_hint",
        payload.alias("raw_payload"),
        F.lit(run_ts).alias("ingested_at"),
        F.to_date(F.lit(run_date)).alias("ingestion_date"),
    )
