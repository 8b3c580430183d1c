"""Run metrics as sketches: merged over runs, against exact figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.operators import sketches

SHARES = {"min": 0.0, "median": 0.5, "max": 1.0}


def _described(df, run):
    return sketches.describe_run(df, run, ["part"], ["who"], ["text"])


def test_merged_runs_equal_one_run_over_all(spark, tmp_path):
    """Forty thousand values in three runs that overlap, one partition with nearly all rows."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 50 == 0, F.lit("b")).otherwise(F.lit("a")).alias("part"),
        (F.col("id") % 9_000).alias("who"), F.repeat(F.lit("x"), (F.col("id") % 700).cast("int")).alias("text"), "id",
    )
    path = str(tmp_path / "runs")
    for run, (low, high) in enumerate([(0, 20_000), (10_000, 30_000), (30_000, 40_000)]):
        sketches.record_run(path, _described(rows.filter((F.col("id") >= low) & (F.col("id") < high)), f"{run}"))
    runs = sketches.read_runs(spark, path)
    got = sketches.estimates(sketches.merge_runs(runs, []), SHARES).first()
    assert (got["n_runs"], got["n_rows"]) == (3, 50_000)
    assert abs(got["who_distinct"] / 9_000 - 1) < sketches.DISTINCT_ERROR
    assert (got["text_min"], got["text_max"]) == (0, 699)
    assert abs(got["text_median"] - 350) < 700 * sketches.RANK_ERROR
    parts = {r["part"]: r for r in sketches.estimates(sketches.merge_runs(runs, ["part"]), SHARES).collect()}
    assert parts["b"]["n_rows"] == 1_000 and parts["b"]["text_max"] == 650
    assert abs(parts["b"]["who_distinct"] / 180 - 1) < sketches.DISTINCT_ERROR


def test_a_run_recorded_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "runs")
    df = spark.createDataFrame([("a", "u", "xx"), ("a", "v", "x")], "part string, who string, text string")
    for _ in range(2):
        sketches.record_run(path, _described(df, "2025-01-01"))
    got = sketches.merge_runs(sketches.read_runs(spark, path), ["part"])
    row = sketches.estimates(got, SHARES).first()
    assert (row["n_runs"], row["n_rows"], row["who_distinct"]) == (1, 2, 2)


def test_nulls_empty_texts_and_empty_tables(spark):
    df = spark.createDataFrame(
        [(None, None, None), (None, "u", ""), ("c", None, None)], "part string, who string, text string"
    )
    merged = sketches.merge_runs(_described(df, "r"), ["part"])
    got = {r["part"]: r for r in sketches.estimates(merged, SHARES).collect()}
    assert (got[None]["n_rows"], got[None]["who_distinct"], got[None]["text_max"]) == (2, 1, 0)
    assert (got["c"]["n_rows"], got["c"]["who_distinct"], got["c"]["text_median"]) == (1, 0, None)
    assert _described(df.limit(0), "r").count() == 0
    assert sketches.describe_run(df.limit(0), "r", [], ["who"], ["text"]).count() == 0
