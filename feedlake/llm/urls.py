"""URL filters by rules on hosts and paths.

A rule fits its host and all subdomains if the path starts with the rule's path.
Every URL is expanded into the host suffixes and path prefixes that a rule could
have; their short hash prefixes are joined with those of the rules, full digests
are compared, and the longest rule that fits decides.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.common import let, lower_ascii
from feedlake.session import broadcast_if_small

ALLOW, BLOCK = "allow", "block"
PREFIX_DIGITS = 8  # hexadecimal digits of the digest that the join compares
RULE_SCHEMA = "host string, path string, verdict string"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def rule_table(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], RULE_SCHEMA)


def url_host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?` or `#`; empty if there is none."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), "^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to `?` or `#`; empty if there is no host part."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host holds no slash and a path is empty or starts with one: the sum is unique.
    return F.sha2(F.concat(host, path), 256)


def _key(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, PREFIX_DIGITS), 16, 10).cast("long")


def _suffixes(host: Column, lengths: list[int]) -> Column:
    """Endings of a host at a label border, of lengths that rules have."""
    size = F.length(host)
    fits = F.filter(
        F.array(*[F.lit(n) for n in lengths]).cast("array<int>"),
        lambda n: (n == size) | ((n < size) & (F.substring(host, size - n, 1) == ".")),
    )
    return F.transform(fits, lambda n: F.substring(host, size - n + 1, n))


def _prefixes(path: Column, slashed: list[int], other: list[int]) -> Column:
    """Beginnings of a path of lengths that rules have.

    Of the lengths at which every rule ends in a slash, only those at a slash.
    """
    size = F.length(path)
    at_slash = F.filter(
        F.array(*[F.lit(n) for n in slashed]).cast("array<int>"),
        lambda n: (n <= size) & (F.substring(path, n, 1) == "/"),
    )
    free = F.filter(F.array(*[F.lit(n) for n in other]).cast("array<int>"), lambda n: n <= size)
    return F.transform(F.concat(at_slash, free), lambda n: F.substring(path, F.lit(1), n))


def _lengths(rules: DataFrame) -> tuple[list[int], list[int], list[int]]:
    """The lengths of hosts and paths in the rules; a URL's length bounds their number."""
    row = rules.agg(
        F.collect_set(F.length("host")).alias("hosts"),
        F.collect_set(F.length("path")).alias("paths"),
        F.collect_set(F.when(~F.col("path").endswith("/"), F.length("path"))).alias("free"),
    ).first()
    return sorted(row["hosts"]), sorted(set(row["paths"]) - set(row["free"])), sorted(row["free"])


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of `pages`.

    Of the rules that fit, the longest wins, then the one with the longer host;
    of equal rules a block. `rule` is null where none fits, and the verdict is
    then `default`. A null URL, or one without `://`, has an empty host and path,
    which only an empty rule would fit. Rows are kept as they are: repeated rows
    and null ids give a row each. Other columns of `pages` are ignored. Rules with
    a null are ignored.
    """
    rules = rules.select("host", "path", "verdict").na.drop().withColumn(
        "host", lower_ascii(F.col("host"))
    )
    hosts, slashed, free = _lengths(rules)
    known = rules.select(
        _key(_digest(F.col("host"), F.col("path"))).alias("_rule_key"),
        _digest(F.col("host"), F.col("path")).alias("_rule_digest"),
        F.length(F.concat("host", "path")).alias("_rule_length"),
        F.length("host").alias("_host_length"),
        (F.col("verdict") == BLOCK).cast("int").alias("_blocks"),
        F.concat("host", "path").alias("_rule"),
        F.col("verdict").alias("_verdict"),
    )
    rows = pages.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias(id_col),
        url_host(F.col(url_col)).alias("host"),
        url_path(F.col(url_col)).alias("path"),
    )
    expressions = let(
        _prefixes(F.col("path"), slashed, free),
        lambda paths: F.flatten(
            F.transform(
                _suffixes(F.col("host"), hosts),
                lambda h: F.transform(paths, lambda p: F.struct(h.alias("h"), p.alias("p"))),
            )
        ),
    )
    wide = rows.select("*", F.explode_outer(expressions).alias("_e"))
    wide = wide.withColumn("_digest", _digest(F.col("_e.h"), F.col("_e.p"))).withColumn(
        "_key", _key(F.col("_digest"))
    )
    hits = wide.join(
        broadcast_if_small(known),
        (F.col("_key") == F.col("_rule_key")) & (F.col("_digest") == F.col("_rule_digest")),
        "left",
    )
    best = F.max(
        F.when(
            F.col("_rule").isNotNull(),
            F.struct("_rule_length", "_host_length", "_blocks", "_rule", "_verdict"),
        )
    ).alias("_best")
    return hits.groupBy("_row", id_col, "host", "path").agg(best).select(
        id_col, "host", "path",
        F.col("_best._rule").alias("rule"),
        F.coalesce("_best._verdict", F.lit(default)).alias("verdict"),
    )
