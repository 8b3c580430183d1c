"""Feed documents, entry identity and times, staging files."""

from __future__ import annotations

import hashlib
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.feeds import article_id, iso_text, plain_time_text, published_at
from feedlake.operators.bronze import build_bronze, load_bronze
from feedlake.sources.feeds import attach_feeds, read_feeds, stage_records
from feedlake.sources.rss import parse_documents, read_feed_files
from feedlake.sources.staging import latest_batch, read_staging, write_staging

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"
 xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Feed</title>
<item><title> A &amp; B </title><link>http://x/?a=1&amp;b=2</link><guid isPermaLink="false">g1</guid>
<pubDate>Tue, 03 Jun 2025 10:11:12 EST</pubDate><description>sum</description>
<content:encoded><![CDATA[<p>one</p>]]></content:encoded>
<content:encoded>two</content:encoded></item>
<item><guid>http://x/2</guid><dc:date>2025-06-03T10:11:12Z</dc:date></item>
<item><guid isPermaLink="false">g3</guid></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><entry><title>T</title>
<id>urn:1</id><link rel="self" href="http://self"/><link href="http://a/1"/>
<updated>2025-06-03T12:11:12+02:00</updated><summary>s</summary>
<content type="html">body</content></entry></feed>"""


def by_id(rows):
    return {r["id"]: r for r in rows}


def test_rss_and_atom(spark):
    docs = spark.createDataFrame(
        [("f", RSS), ("g", ATOM), ("h", "no xml"), ("i", "<rss><channel/></rss>"), ("j", None)],
        "feed_id string, xml string",
    )
    rows = by_id(parse_documents(docs, "xml").collect())
    assert set(rows) == {"g1", "http://x/2", "g3", "urn:1"}
    first = rows["g1"]
    assert (first["title"], first["link"], first["summary"]) == ("A & B", "http://x/?a=1&b=2", "sum")
    assert first["body"] == "<p>one</p>" and first["feed_id"] == "f"
    assert rows["http://x/2"]["link"] == "http://x/2" and rows["http://x/2"]["body"] is None
    assert rows["g3"]["link"] is None
    atom = rows["urn:1"]
    assert (atom["link"], atom["body"], atom["summary"]) == ("http://a/1", "body", "s")


def test_feed_files_and_staging_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.xml").write_text(RSS)
    (tmp_path / "in" / "g.xml").write_text(ATOM)
    registry = tmp_path / "feeds.json"
    registry.write_text(
        "\n".join(
            json.dumps({"feed_id": f, "region": "emea", "language_hint": h, "source_type": "rss"})
            for f, h in (("f", "en"), ("g", None))
        )
    )
    entries = read_feed_files(spark, str(tmp_path / "in")).withColumn(
        "feed_id", F.regexp_extract("file", r"([^/]+)\.xml$", 1)
    )
    feeds = read_feeds(spark, str(registry))
    records = stage_records(
        attach_feeds(entries, feeds), "2025-06-04T00:00:00+00:00", "2025-06-04"
    ).collect()
    assert len(records) == 4
    found = {r["article_id"]: r for r in records}

    def expected_id(feed, link):
        return f"{feed}_{hashlib.sha256(f'{feed}:{link}'.encode()).hexdigest()[:32]}"

    first = found[expected_id("f", "http://x/?a=1&b=2")]
    assert first["published_at"] == "2025-06-03T15:11:12+00:00"  # EST has no daylight time
    assert json.loads(first["raw_payload"])["title"] == "A & B"
    # Without a link the entry's id makes the identity, but not the url.
    assert found[expected_id("f", "g3")]["source_url"] is None
    assert found[expected_id("g", "http://a/1")]["published_at"] == "2025-06-03T10:11:12+00:00"
    fallback = stage_records(
        attach_feeds(entries, feeds), "2025-06-04T00:00:00+00:00", "2025-06-04",
        url_fallback=True, keep_published=False,
    ).collect()
    assert {r["source_url"] for r in fallback} >= {"g3"}
    assert {r["published_at"] for r in fallback} == {None}


def test_identity_and_times(spark):
    df = spark.createDataFrame(
        [("f", "", "i"), ("f", None, None), ("f", "l", "i")], "f string, l string, i string"
    )
    ids = [r[0] for r in df.select(article_id(F.col("f"), F.col("l"), F.col("i"))).collect()]
    assert ids == [
        "f_" + hashlib.sha256(f"f:{x}".encode()).hexdigest()[:32] for x in ("i", "", "l")
    ]
    dates = [
        ("Tue, 03 Jun 2025 10:11:12 GMT", None, "2025-06-03 10:11:12"),
        ("3 Jun 2025 10:11 +0200", None, "2025-06-03 08:11:00"),
        ("Tue, 03 Jun 2025 10:11:12 EDT", None, "2025-06-03 14:11:12"),
        ("Tue, 03 Jun 2025 10:11:12", None, "2025-06-03 10:11:12"),
        ("2025-06-03T10:11:12.5+01:00", None, "2025-06-03 09:11:12.500000"),
        ("junk", "2025-06-03", "2025-06-03 00:00:00"),
        (None, None, None),
    ]
    rows = spark.createDataFrame([d[:2] for d in dates], "p string, u string").select(
        plain_time_text(published_at(F.col("p"), F.col("u")))
    )
    assert [r[0] for r in rows.collect()] == [d[2] for d in dates]
    texts = spark.sql(
        "SELECT timestamp'2025-01-01 00:00:05' AS a, timestamp'2025-01-01 00:00:05.25' AS b"
    ).select(iso_text(F.col("a")), iso_text(F.col("b"))).first()
    assert list(texts) == ["2025-01-01T00:00:05+00:00", "2025-01-01T00:00:05.250000+00:00"]


def test_staging_files(spark, tmp_path):
    root = str(tmp_path / "staging")
    with pytest.raises(FileNotFoundError):
        os.makedirs(root)
        latest_batch(spark, root)

    def batch(article, date, run):
        row = {c: None for c in schemas.STAGING.fieldNames()}
        row.update(article_id=article, raw_payload='{"b": [1, {"c": null}]}')
        df = spark.createDataFrame([row], schemas.STAGING)
        return write_staging(df.withColumn("ingestion_date", F.to_date(F.lit(date))), root, date, run)

    batch("new date", "2025-01-02", "a")
    time.sleep(1.1)
    newest = batch("older date, staged later", "2025-01-01", "b")
    assert newest.endswith("2025/01/01/batch_b")
    found = latest_batch(spark, root)
    assert found.endswith("2025/01/01/batch_b")
    assert [r["article_id"] for r in read_staging(spark, found).collect()] == [
        "older date, staged later"
    ]
    rows = read_staging(spark, root).collect()
    assert len(rows) == 2
    assert {r["raw_payload"] for r in rows} == {'{"b": [1, {"c": null}]}'}


def test_nested_payload_and_corrupt_lines(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text(
        '{"article_id": "1", "raw_payload": {"x": 1, "y": [1,  2]}, "ingestion_date": "2025-01-01"}\n'
        "not json\n"
        '{"article_id": "2", "published_at": "junk", "ingested_at": "2025-01-01T05:00:00+02:00"}\n'
    )
    rows = read_staging(spark, str(tmp_path), "_bad").collect()
    bad = [r for r in rows if r["_bad"] is not None]
    assert [r["_bad"] for r in bad] == ["not json"]
    good = {r["article_id"]: r for r in rows if r["_bad"] is None}
    assert json.loads(good["1"]["raw_payload"]) == {"x": 1, "y": [1, 2]}
    bronze = load_bronze(read_staging(spark, str(tmp_path)), "2025-03-01")
    two = bronze.filter("article_id = '2'").select(
        "published_at", F.col("ingested_at").cast("string"), F.col("ingestion_date").cast("string")
    ).first()
    assert list(two) == [None, "2025-01-01 03:00:00", "2025-03-01"]
    # No date given: the column stays NULL.
    assert load_bronze(read_staging(spark, str(tmp_path)), "").filter(
        "article_id = '2' AND ingestion_date IS NULL"
    ).count() == 1


def test_payload_struct_is_written_as_json(spark):
    df = spark.createDataFrame([("1",)], "article_id string")
    for c in schemas.STAGING.fieldNames()[1:]:
        df = df.withColumn(c, F.lit(None).cast(schemas.STAGING[c].dataType))
    df = df.withColumn(
        "raw_payload", F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    )
    assert build_bronze(df).first()["raw_payload"] == '{"a":1}'
