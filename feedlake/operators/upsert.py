"""Merging frames by key, and marking rows, as DataFrame operators."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.operators.dedup import keep_first
from feedlake.session import broadcast_if_small, materialize, plan_bytes

MAX_REPEATED = 100_000  # keys that are sent to all executors
WHOLE_BYTES = 64 << 20  # of frames that are shuffled whole, without a search for the rows that matter


def is_large(df: DataFrame) -> bool:
    return plan_bytes(df) > WHOLE_BYTES


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys, where NULL equals NULL."""
    return functools.reduce(operator.and_, [left[k].eqNullSafe(right[k]) for k in keys])


def repeated_keys(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that several rows have, written."""
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts.filter("n > 1").select(*keys), "repeated")


def keep_first_of(df: DataFrame, keys: list[str], order: list[Column], repeated: DataFrame) -> DataFrame:
    """Like ``keep_first``, where the keys that have several rows are known: where they are few, no others are shuffled.

    ``df`` is then read twice, and gives the same rows both times.
    """
    if repeated.isEmpty():
        return df
    if repeated.limit(MAX_REPEATED + 1).count() > MAX_REPEATED:
        return keep_first(df, keys, order)
    few = F.broadcast(repeated)
    again = keep_first(df.join(few, same_keys(df, few, keys), "left_semi"), keys, order)
    return df.join(few, same_keys(df, few, keys), "left_anti").unionByName(again)


def with_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` with a key in ``wanted``. Its keys are searched first, without other columns.

    Where few rows of a large frame are found, no others are shuffled.
    """
    if not is_large(df):
        return df.join(wanted, same_keys(df, wanted, keys), "left_semi")
    found = df.select(*keys).join(wanted, same_keys(df, wanted, keys), "left_semi").distinct()
    few = broadcast_if_small(materialize(found, "found_keys"))
    return df.join(few, same_keys(df, few, keys), "left_semi")


def append_evolve(target: DataFrame, source: DataFrame) -> DataFrame:
    """All rows of both; columns that one side lacks are NULL there. Duplicates stay."""
    return target.unionByName(source, allowMissingColumns=True)


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None
) -> DataFrame:
    """Target rows with no source row of the same key, and the source rows.

    ``order`` picks among source rows of one key; without it they must be
    unique. Applying the same source twice changes nothing, also for NULL keys.
    """
    if order is not None:
        source = keep_first(source, keys, order)
    wanted = source.select(*keys)
    untouched = target.join(wanted, same_keys(target, wanted, keys), "left_anti")
    return append_evolve(untouched, source)


def upsert_newest(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[Column]
) -> DataFrame:
    """The first row of each key by ``order`` over both sides, whichever side it is on.

    Use it where sources may arrive out of order: the result does not depend on
    the order of arrival.
    """
    return keep_first(append_evolve(target, source), keys, order)


def mark_embedded(gold: DataFrame, done: DataFrame) -> DataFrame:
    """Gold with ``embedded_at`` taken from ``done`` (chunk_id, embedded_at) where it lists a chunk.

    Chunks not listed keep what they have; unknown ids add nothing.
    """
    stamps = done.groupBy("chunk_id").agg(F.max("embedded_at").alias("_stamp"))
    marked = gold.join(stamps, "chunk_id", "left").withColumn(
        "embedded_at", F.coalesce("_stamp", "embedded_at")
    )
    return marked.select(*gold.columns)
