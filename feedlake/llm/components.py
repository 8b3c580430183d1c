"""Connected components by alternating stars, on tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import written
from feedlake.session import broadcast_if_small, materialize

MAX_TURNS = 100
SENT_ROWS = 200_000  # pairs of ids that are sent to all tasks; more are joined by a shuffle


def _with_least(edges: DataFrame, few: bool) -> DataFrame:
    """(u, v, m): every edge with the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    if few:
        least = F.broadcast(least)
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every larger neighbour is linked to the least one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, few).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Every smaller neighbour, and the vertex itself, is linked to the least one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    linked = _with_least(down, few)
    return (
        linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(linked.select("u", F.col("m").alias("v")))
        .filter("u != v").distinct()
    )


def _measured(edges: DataFrame) -> tuple[DataFrame, dict]:
    return written(
        edges, "edges", n=F.count(F.lit(1)), digest=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each vertex that is not the least of its component, with that least one.

    `edges` has columns u and v; loops and repeated edges do no harm. Each turn is
    written, which bounds the lineage; a turn that changes no edge ends the search.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    edges, mark = _measured(edges.distinct())
    for _ in range(MAX_TURNS):
        if not mark["n"]:
            return edges
        few = mark["n"] <= SENT_ROWS
        edges, now = _measured(_small_star(_large_star(edges, few), few))
        if now == mark:
            return edges
        mark = now
    raise RuntimeError("components did not settle")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components as `components` gives them, after further links (u, v) between any vertices.

    Only the components that the links join are looked at.
    """
    known = broadcast_if_small(labels.select(F.col("u").alias("_u"), F.col("v").alias("_v")), SENT_ROWS)
    joined = links
    for end in ("u", "v"):
        joined = joined.join(known, F.col(end) == F.col("_u"), "left").select(
            *[F.coalesce("_v", c).alias(c) if c == end else F.col(c) for c in ("u", "v")]
        )
    moved = components(joined)
    further = broadcast_if_small(moved.select(F.col("u").alias("_u"), F.col("v").alias("_v")), SENT_ROWS)
    return materialize(
        labels.join(further, F.col("v") == F.col("_u"), "left")
        .select("u", F.coalesce("_v", "v").alias("v")).unionByName(moved),
        "labels",
    )
