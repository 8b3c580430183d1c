"""Feed documents (RSS 2.0 and Atom) to one row per entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.feeds import entry_body

_TEXT = "struct<_VALUE:string>"
_ITEM = (
    "struct<title:string,link:string,guid:struct<_VALUE:string,_isPermaLink:string>,"
    "pubDate:string,`dc:date`:string,description:string,`content:encoded`:array<string>,"
    f"author:string,`dc:creator`:array<string>,category:array<{_TEXT}>,"
    "enclosure:array<struct<_url:string,_type:string>>>"
)
_ENTRY = (
    "struct<title:string,id:string,link:array<struct<_href:string,_rel:string,_type:string>>,"
    f"published:string,updated:string,summary:string,content:array<{_TEXT}>,"
    "author:array<struct<name:string>>,category:array<struct<_term:string>>>"
)
DOCUMENT = f"channel struct<item:array<{_ITEM}>>, entry array<{_ENTRY}>"
ENTRY = (
    "title string, link string, id string, published string, updated string, "
    "summary string, contents array<struct<value:string>>, authors array<string>, "
    "tags array<string>, enclosures array<struct<href:string,type:string>>"
)


def _contents(values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(v.alias("value")))


def _list(values: Column) -> Column:
    return F.coalesce(values, F.array().cast("array<string>"))


def _some(values: Column) -> Column:
    """The values that are there; NULL without any."""
    there = F.array_compact(values)
    return F.when(F.size(there) > 0, there)


def _rss_entry(item: Column) -> Column:
    guid = item["guid"]
    # A guid is a link unless it says otherwise.
    permalink = F.when(F.coalesce(guid["_isPermaLink"], F.lit("true")) != "false", guid["_VALUE"])
    return F.struct(
        F.trim(item["title"]).alias("title"),
        F.coalesce(item["link"], permalink).alias("link"),
        guid["_VALUE"].alias("id"),
        item["pubDate"].alias("published"),
        item["dc:date"].alias("updated"),
        F.trim(item["description"]).alias("summary"),
        _contents(item["content:encoded"]).alias("contents"),
        _some(F.concat(F.array(item["author"]), _list(item["dc:creator"]))).alias("authors"),
        _some(F.transform(item["category"], lambda c: F.trim(c["_VALUE"]))).alias("tags"),
        F.transform(
            item["enclosure"], lambda e: F.struct(e["_url"].alias("href"), e["_type"].alias("type"))
        ).alias("enclosures"),
    )


def _atom_entry(entry: Column) -> Column:
    alternate = F.filter(
        entry["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"
    )
    return F.struct(
        F.trim(entry["title"]).alias("title"),
        F.get(alternate, F.lit(0))["_href"].alias("link"),
        entry["id"].alias("id"),
        entry["published"].alias("published"),
        entry["updated"].alias("updated"),
        F.trim(entry["summary"]).alias("summary"),
        _contents(F.transform(entry["content"], lambda c: c["_VALUE"])).alias("contents"),
        _some(F.transform(entry["author"], lambda x: F.trim(x["name"]))).alias("authors"),
        _some(F.transform(entry["category"], lambda x: x["_term"])).alias("tags"),
        F.transform(
            F.filter(entry["link"], lambda x: x["_rel"] == "enclosure"),
            lambda x: F.struct(x["_href"].alias("href"), x["_type"].alias("type")),
        ).alias("enclosures"),
    )


def parse_documents(documents: DataFrame, xml: str) -> DataFrame:
    """One row per entry of the feed documents in column ``xml``; other columns stay.

    ``body`` is the first of the ``contents``. Documents that are not XML, and
    feeds without entries, give no rows.
    """
    keep = [c for c in documents.columns if c != xml]
    parsed = documents.select(*keep, F.from_xml(xml, DOCUMENT, {"mode": "PERMISSIVE"}).alias("d"))
    items = F.transform(F.coalesce(F.col("d.channel.item"), F.array()), _rss_entry)
    entries = F.transform(F.coalesce(F.col("d.entry"), F.array()), _atom_entry)
    return (
        parsed.select(*keep, F.explode(F.concat(items, entries)).alias("e"))
        .select(*keep, "e.*")
        .withColumn("body", entry_body(F.col("contents")))
    )


def read_feed_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per entry of the feed documents under ``path``, one document per file.

    A document is read whole: it holds a feed's latest entries, not its history.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return parse_documents(
        files.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("xml")), "xml"
    )
