"""Chunks of cleaned articles, ready for embedding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import fixed
from feedlake.functions.chunks import chunk_structs, tokens_of_words
from feedlake.operators.order import running_before
from feedlake.profiles import CLUSTER, Profile
from feedlake.session import broadcast_if_small

LINEAGE = ["article_id", "feed_id", "region", "language"]


def explode_chunks(articles: DataFrame, profile: Profile = CLUSTER) -> DataFrame:
    """One row per window with ``chunk_index``, ``chunk_text`` and ``n_words``; other columns stay.

    The content is cleaned text, in which blanks are the only white space.
    """
    keep = [c for c in articles.columns if c != "content"]
    windows = chunk_structs(F.col("content"), profile.chunks, blanks_only=True)
    return articles.select(*keep, F.posexplode(windows).alias("chunk_index", "_c")).select(
        *keep, "chunk_index", "_c.*"
    )


def build_gold(
    silver: DataFrame, profile: Profile = CLUSTER, as_of: Column | None = None
) -> DataFrame:
    """Silver to gold. Windows that are too short go after numbering, so gaps can occur."""
    n_words = F.col("n_words")
    gold = explode_chunks(silver, profile).select(
        F.concat_ws("_", "article_id", F.col("chunk_index").cast("string")).alias("chunk_id"),
        *LINEAGE,
        "chunk_index",
        "chunk_text",
        F.when(n_words == 0, F.lit(0)).otherwise(tokens_of_words(n_words)).alias("token_count"),
        "published_at",
        "source_url",
        "metadata",
        (F.current_timestamp() if as_of is None else as_of).alias("created_at"),
        "ingestion_date",
        F.lit(None).cast("timestamp").alias("embedded_at"),
    )
    if profile.min_chunk_chars is None:
        return gold
    return gold.filter(F.length("chunk_text") > profile.min_chunk_chars)


def chunks_before(
    silver: DataFrame, ordinal: str, profile: Profile = CLUSTER, keep: list[str] | None = None
) -> DataFrame:
    """Articles with ``n_chunks`` and ``chunks_before``, the chunks of all articles before in input order.

    ``ordinal`` is unique. Articles without chunks are left out; of the other columns
    those in ``keep`` stay, or all but the content.
    """
    n_chunks = F.size(chunk_structs(F.col("content"), profile.chunks, blanks_only=True))
    keep = [c for c in silver.columns if c not in ("content", ordinal)] if keep is None else keep
    counted = silver.select(ordinal, *keep, n_chunks.cast("long").alias("n_chunks")).filter("n_chunks > 0")
    return running_before(counted, [ordinal], F.col("n_chunks"), "chunks_before")


def sample_articles(silver: DataFrame, ordinal: str, max_articles: int, profile: Profile) -> DataFrame:
    """The first articles in input order, up to the one that completes the sample's chunks.

    The sample is full at five chunks per article asked for; the article that
    fills it comes whole.
    """
    budget = max_articles * fixed.CHUNKS_PER_SAMPLED_ARTICLE
    chosen = chunks_before(silver, ordinal, profile, []).filter(F.col("chunks_before") < budget)
    return silver.join(broadcast_if_small(chosen.select(ordinal)), ordinal, "left_semi")
