"""What runs put out, as sketches that are merged over runs and partitions without reading data again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Relative error of distinct counts: 1.04 / sqrt(2 ** 12) = 1.6 %, so 5 % at three deviations.
DISTINCT_LOG_K = 12
DISTINCT_ERROR = 0.05
# Error of a quantile's rank: 0.7 % for 400 items kept a level; 2 % is far outside.
QUANTILE_K = 400
RANK_ERROR = 0.02


def describe_run(
    rows: DataFrame, run_id: str, by: list[str], distinct: list[str], sized: list[str]
) -> DataFrame:
    """One row per partition of a run's output: ``run_id``, ``by``, ``n_rows`` and sketches.

    ``<c>_distinct`` counts the different values of a column, ``<c>_sizes`` holds the lengths
    of a text column. NULL is no value and has no length; the sketch of a column without
    values is empty. No rows give no row. Sketches are partial aggregates of a few kilobytes, so
    a partition that holds most rows shuffles one sketch per task.
    """
    taken = rows.select(
        *[F.col(f"`{c}`").alias(f"b{i}") for i, c in enumerate(by)],
        *[F.col(f"`{c}`").cast("string").alias(f"d{i}") for i, c in enumerate(distinct)],
        *[F.length(F.col(f"`{c}`")).cast("long").alias(f"s{i}") for i, c in enumerate(sized)],
    )
    keys = [f"b{i}" for i in range(len(by))]
    sketches = [F.hll_sketch_agg(f"d{i}", DISTINCT_LOG_K).alias(f"{c}_distinct") for i, c in enumerate(distinct)]
    sketches += [F.kll_sketch_agg_bigint(f"s{i}", QUANTILE_K).alias(f"{c}_sizes") for i, c in enumerate(sized)]
    grouped = taken.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *sketches)
    if not by:  # an aggregate without keys gives a row for no rows
        grouped = grouped.filter("n_rows > 0")
    names = [F.col(k).alias(c) for k, c in zip(keys, by)]
    rest = [c for c in grouped.columns if c not in keys]
    return grouped.select(F.lit(run_id).alias("run_id"), *names, *rest)


def record_run(path: str, described: DataFrame) -> None:
    """Add a run to the table of runs, a partition each; a run recorded again replaces itself."""
    writer = described.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run_id").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All recorded runs; columns that only some runs have are NULL in the others."""
    schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    fields = [StructField(f.name, StringType()) if f.name == "run_id" else f for f in schema]
    return spark.read.schema(StructType(fields)).parquet(path)


def merge_runs(runs: DataFrame, by: list[str]) -> DataFrame:
    """Runs and partitions merged: one row per ``by`` with ``n_runs``, ``n_rows`` and merged sketches."""
    merged: list[Column] = [F.count_distinct("run_id").alias("n_runs"), F.sum("n_rows").alias("n_rows")]
    for c in runs.columns:
        if c.endswith("_distinct"):
            merged.append(F.hll_union_agg(f"`{c}`").alias(c))
        elif c.endswith("_sizes"):
            merged.append(F.kll_merge_agg_bigint(f"`{c}`", QUANTILE_K).alias(c))
    return runs.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*merged)


def estimates(merged: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Numbers instead of sketches: ``<c>_distinct``, and for each share ``<c>_<name>``.

    Shares 0 and 1 are the least and the greatest length, exactly. Where no row had a value
    the count is 0 and the lengths are NULL.
    """
    out: list[Column] = []
    for c in merged.columns:
        held = F.col(f"`{c}`")
        if c.endswith("_distinct"):
            out.append(F.coalesce(F.hll_sketch_estimate(held), F.lit(0)).cast("long").alias(c))
        elif c.endswith("_sizes"):
            some = F.kll_sketch_get_n_bigint(held) > 0
            out += [
                F.when(some, F.kll_sketch_get_quantile_bigint(held, F.lit(share))).alias(f"{c[:-6]}_{name}")
                for name, share in shares.items()
            ]
        else:
            out.append(held)
    return merged.select(*out)
