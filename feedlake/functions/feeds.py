"""Identity, time and body of feed entries, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import fixed

DATE_PATTERNS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss")


def entry_link(link: Column, entry_id: Column) -> Column:
    """The link, else the entry's own id, else ''. Empty text counts as absent."""
    return F.coalesce(F.nullif(link, F.lit("")), F.nullif(entry_id, F.lit("")), F.lit(""))


def article_id(feed_id: Column, link: Column, entry_id: Column) -> Column:
    """A stable id: the feed, and a digest of feed and link."""
    digest = F.sha2(F.concat_ws(":", feed_id, entry_link(link, entry_id)), 256)
    return F.concat_ws("_", feed_id, F.substring(digest, 1, fixed.ARTICLE_HASH_CHARS))


def _feed_time(text: Column) -> Column:
    # Spark parses no weekday, and would read EST in June as daylight time.
    plain = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},\s*", "")
    for zone, offset in fixed.ZONE_OFFSETS.items():
        plain = F.regexp_replace(plain, rf"(?<=[0-9]) {zone}$", f" {offset}")
    parsed = [F.try_to_timestamp(plain, F.lit(p)) for p in DATE_PATTERNS]
    return F.coalesce(*parsed, F.try_to_timestamp(F.trim(text)))


def published_at(published: Column, updated: Column) -> Column:
    """Publication time, else time of update, as UTC; NULL where neither can be read."""
    return F.coalesce(_feed_time(published), _feed_time(updated))


def entry_body(contents: Column) -> Column:
    """The first content element's value; NULL where there is none."""
    return F.get(contents, F.lit(0)).getField("value")


def iso_text(ts: Column) -> Column:
    """ISO 8601 with offset; a fraction is written only where there is one."""
    return F.when(
        F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def plain_time_text(ts: Column) -> Column:
    """Date, blank, time; a fraction is written only where there is one."""
    return F.when(
        F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
