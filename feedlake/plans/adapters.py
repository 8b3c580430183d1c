"""The given tables viewed as feeds, staged articles, vectors, requests and model outputs.

Each view has a twin of the same name in `sql`.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.feeds import article_id, iso_text
from feedlake.functions.vectors import json_text
from feedlake.operators.bronze import build_bronze
from feedlake.operators.gold import build_gold
from feedlake.operators.silver import build_silver
from feedlake.profiles import CLUSTER, LOCAL, Profile

SPREAD_BYTES = 64 << 20
EPOCH_2025 = 1_735_689_600  # 2025-01-01T00:00:00Z
AS_OF = "2025-02-01 00:00:00"
RUN_TS, RUN_DATE = "2025-01-01T06:00:00+00:00", "2025-01-01"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str, *spread_by: str) -> DataFrame:
    """A given table, read as it lies.

    One of a few megabytes may be a single split, which would keep all cores but one idle.
    It is dealt over them by its key ``spread_by``; that moves ``SPREAD_BYTES`` at most.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread_by and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= SPREAD_BYTES:
        return df.repartition(spark.sparkContext.defaultParallelism, *spread_by)
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id")


def region_of(source: Column) -> Column:
    number = F.substring(source, 4, 10).cast("int") % 3
    return (
        F.when(number == 0, F.lit("global")).when(number == 1, F.lit("emea"))
        .otherwise(F.lit("americas"))
    )


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed per source of the documents."""
    return (
        table(spark, sf_dir, "documents").groupBy(F.col("source").alias("feed_id"))
        .agg(F.min("lang").alias("language_hint"))
        .select(
            "feed_id",
            region_of(F.col("feed_id")).alias("region"),
            "language_hint",
            F.lit("rss").alias("source_type"),
            F.concat(F.lit("http://"), "feed_id", F.lit("/rss")).alias("url"),
            F.lit(15).alias("poll_interval_minutes"),
        )
    )


def feed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An RSS document per page: (feed_id, page_id, xml).

    Every fifth page has two items, every seventh a guid in place of the link,
    which for every fourteenth is no link. Dates come in four formats, or are
    unreadable. Even pages carry their HTML as content, odd ones as description.
    """
    pages = table(spark, sf_dir, "pages", "page_id")
    n = F.col("page_id")

    def escaped(text: Column) -> Column:
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(plain), F.lit(entity))
        return text

    def at(hours: int, pattern: str) -> Column:
        return F.date_format(F.timestamp_seconds(n * 3600 + EPOCH_2025 + hours * 3600), pattern)

    rfc, iso = "EEE, dd MMM yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'"
    published = (
        F.when(n % 5 == 0, F.concat(at(0, rfc), F.lit(" GMT")))
        .when(n % 5 == 1, F.concat(at(2, rfc), F.lit(" +0200")))
        .when(n % 5 == 2, F.concat(at(-5, rfc), F.lit(" EST")))
        .when(n % 5 == 3, at(0, iso))
        .otherwise(F.lit("some day"))
    )
    updated = F.when(n % 2 == 0, F.concat(F.lit("<dc:date>"), at(1, iso), F.lit("</dc:date>")))
    html = escaped(F.col("html"))

    def item(suffix: str) -> Column:
        url = escaped(F.concat("url", F.lit(suffix)))
        link = (
            F.when(n % 14 == 0, F.concat(F.lit('<guid isPermaLink="false">'), url, F.lit("</guid>")))
            .when(n % 7 == 0, F.concat(F.lit("<guid>"), url, F.lit("</guid>")))
            .otherwise(F.concat(F.lit("<link>"), url, F.lit("</link>")))
        )
        return F.concat(
            F.lit("<item><title>Page "), n.cast("string"), F.lit(f"{suffix}</title>"), link,
            F.lit("<pubDate>"), published, F.lit("</pubDate>"), F.coalesce(updated, F.lit("")),
            F.when(
                n % 2 == 0, F.concat(F.lit("<content:encoded>"), html, F.lit("</content:encoded>"))
            ).otherwise(F.concat(F.lit("<description>"), html, F.lit("</description>"))),
            F.when(
                n % 3 == 0, F.lit("<author>ann@news.example</author><dc:creator>Bob</dc:creator>")
            ).otherwise(F.lit("")),
            F.lit('<category>news</category><category domain="d">t'), (n % 4).cast("string"),
            F.lit("</category>"),
            F.when(
                n % 6 == 0,
                F.concat(
                    F.lit('<enclosure url="http://x.example/'), n.cast("string"),
                    F.lit('.mp3" type="audio/mpeg" length="5"/>'),
                ),
            ).otherwise(F.lit("")),
            F.lit("</item>"),
        )

    return pages.select(
        F.concat(F.lit("src"), (n % 20).cast("string")).alias("feed_id"),
        "page_id",
        F.concat(
            F.lit(
                '<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" '
                'xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'
            ),
            item(""),
            F.when(n % 5 == 0, item("#2")).otherwise(F.lit("")),
            F.lit("</channel></rss>"),
        ).alias("xml"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as typed bronze rows, with doc_id, which is their place in the run.

    A run has one time of ingestion. Title and body are missing here and there, the
    summary then holds the whole text.
    """
    n = F.col("doc_id")
    url = F.concat(F.lit("http://"), "source", F.lit("/"), n.cast("string"))
    return documents(spark, sf_dir).select(
        "doc_id",
        article_id(F.col("source"), url, F.lit("")).alias("article_id"),
        F.col("source").alias("feed_id"),
        region_of(F.col("source")).alias("region"),
        F.lit("rss").alias("source_type"),
        url.alias("source_url"),
        F.concat(F.lit("Document "), n.cast("string")).alias("title"),
        F.when(n % 25 != 0, F.col("text")).alias("summary"),
        F.when(n % 10 != 0, F.col("text")).alias("body"),
        F.when(n % 7 != 0, F.timestamp_seconds(n % 24 * 3600 + EPOCH_2025)).alias("published_at"),
        F.when(n % 11 != 0, F.upper("lang")).alias("language_hint"),
        F.concat(F.lit('{"doc_id":'), n.cast("string"), F.lit("}")).alias("raw_payload"),
        F.timestamp_seconds(F.lit(EPOCH_2025 + 6 * 3600)).alias("ingested_at"),
        F.date_add(F.lit(RUN_DATE).cast("date"), (n % 3).cast("int")).alias("ingestion_date"),
    )


def late_copies(articles_df: DataFrame) -> DataFrame:
    """The French articles again, an hour later and with another title."""
    return (
        articles_df.filter(F.col("language_hint") == "FR")
        .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
        .withColumn("title", F.concat(F.lit("Late "), "title"))
    )


def shorter_copies(articles_df: DataFrame) -> DataFrame:
    """The French articles again, an hour later and with every other word of body and summary."""

    def halved(c: str) -> Column:
        kept = F.filter(F.split(c, " "), lambda _, i: i % 2 == 0)
        return F.array_join(kept, " ")

    later = articles_df.filter(F.col("language_hint") == "FR").withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")
    )
    return later.withColumns({"body": halved("body"), "summary": halved("summary")})


def articles_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = articles(spark, sf_dir)
    return base.unionByName(late_copies(base))


def staged(rows: DataFrame) -> DataFrame:
    """Articles as staging records: times are text."""
    changed = {c: iso_text(F.col(c)).alias(c) for c in ("published_at", "ingested_at")}
    return rows.select(*[changed.get(c, F.col(c)) for c in schemas.STAGING.fieldNames()])


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows with their place in the input."""
    rows = articles(spark, sf_dir)
    changed = {c: iso_text(F.col(c)) for c in ("published_at", "ingested_at")}
    return build_bronze(rows.withColumns({**changed, "ordinal": F.col("doc_id")}))


def silver(spark: SparkSession, sf_dir: str, profile: Profile = CLUSTER) -> DataFrame:
    return build_silver(bronze(spark, sf_dir), profile, as_of())


def gold(spark: SparkSession, sf_dir: str, profile: Profile = CLUSTER) -> DataFrame:
    return build_gold(silver(spark, sf_dir, profile), profile, as_of())


local_silver = functools.partial(silver, profile=LOCAL)
local_gold = functools.partial(gold, profile=LOCAL)


def half_embedded(gold_df: DataFrame) -> DataFrame:
    """Gold in which the chunks of even index have been embedded before."""
    return gold_df.withColumn("embedded_at", F.when(F.col("chunk_index") % 2 == 0, as_of()))


def next_day(gold_df: DataFrame) -> DataFrame:
    """The French chunks again, a day later, in capitals and not embedded."""
    return gold_df.filter(F.col("language") == "fr").withColumns({
        "chunk_text": F.upper("chunk_text"), "ingestion_date": F.date_add("ingestion_date", 1),
        "embedded_at": F.lit(None).cast("timestamp"),
    })


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as vector records: (id, namespace, language, values, label, metadata)."""
    label, n = F.col("label"), F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        n.cast("string").alias("id"),
        F.element_at(
            F.array(*[F.lit(x) for x in ("global", "emea", "americas")]), label % 3 + 1
        ).alias("namespace"),
        F.element_at(
            F.array(*[F.lit(x) for x in ("en", "de", "es", "fr")]), (n % 4).cast("int") + 1
        ).alias("language"),
        F.col("embedding").alias("values"),
        "label",
    )


def vector_queries(vectors_df: DataFrame) -> DataFrame:
    """Every twentieth vector as a query, in its label's region, half of the labels with a language."""
    label = F.col("label")
    return vectors_df.filter(F.col("id").cast("long") % 20 == 0).select(
        F.col("id").alias("query_id"),
        F.when(label % 3 == 1, F.lit(" EMEA ")).when(label % 3 == 2, F.lit("Americas")).alias("region"),
        F.when(label % 2 == 0, F.lit("en")).alias("language"),
        F.col("values").cast("array<double>").alias("embedding"),
    )


def label_queries(vectors_df: DataFrame) -> DataFrame:
    """A query per label: the mean of its vectors, in the label's region, half with a language."""
    label = F.col("label")
    means = (
        vectors_df.select("label", F.posexplode("values").alias("pos", "x"))
        .groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v"))
    )
    return means.select(
        label.cast("string").alias("query_id"),
        F.when(label % 3 == 1, F.lit(" EMEA ")).when(label % 3 == 2, F.lit("Americas")).alias(
            "region"
        ),
        F.when(label % 2 == 0, F.lit("en")).alias("language"),
        F.col("v.x").alias("embedding"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users' turns as requests, and three that hit common, no, or too short words."""
    n = F.col("conv_id")
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn").filter(F.col("role") == "user").select(
        F.concat_ws("_", n.cast("string"), F.col("turn").cast("string")).alias("query_id"),
        F.col("text").alias("query"),
        F.when(n % 3 == 1, F.lit("emea")).when(n % 3 == 2, F.lit("Americas")).alias("region"),
        F.when(n % 4 == 0, F.lit("en")).when(n % 4 == 1, F.lit("")).alias("language"),
        F.concat(F.lit("s"), n.cast("string")).alias("session_id"),
    )
    fixed_rows = spark.sql(
        "SELECT query_id, query, CAST(NULL AS STRING) AS region, CAST(NULL AS STRING) AS language, "
        "'s' AS session_id FROM VALUES ('x1', 'that tion there'), ('x2', 'zzzz qqqq'), "
        "('x3', 'a of') AS t(query_id, query)"
    )
    return turns.unionByName(fixed_rows)


def model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn turned into raw model output of one of twelve kinds, most of them faulty."""
    n = (F.col("conv_id") + F.col("turn")) % 12
    text = json_text(F.col("text"))

    def made(before: str, after: str = "}") -> Column:
        return F.concat(F.lit(before), text, F.lit(after))

    kinds = [
        made('{"route":"trend_analyzer","confidence":0.9,"detected_region":"emea","rationale":'),
        made('{"route":"procurement_planner","confidence":1.7,"rationale":'),
        made('{"route":"procurement_planner","confidence":"0.8","x":1,"rationale":'),
        made('{"route":"x","confidence":0.5,"rationale":"supplier","summary":'),
        F.col("text"),
        made("[1, ", "]"),
        made('{"route":"trend_analyzer","confidence":NaN,"rationale":"r","summary":'),
        made('{"route":"trend_analyzer","confidence":0.5,"rationale":5,"executive_summary":'),
        made('{"route":"trend_analyzer","confidence":0.5,"key_trends":["a","b"],"summary":'),
        F.concat(F.lit("SOURCING now "), F.col("text")),
        F.lit(""),
        made('{"route":"trend_analyzer","confidence":null,"supplier_risks":[],"rationale":'),
    ]
    raw = F.when(n == 0, kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        raw = raw.when(n == i, kind)
    return table(spark, sf_dir, "conversations", "conv_id", "turn").select(
        "conv_id", "turn", n.cast("int").alias("kind"), "text", raw.alias("raw")
    )
