"""Running sums and positions over a whole frame, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.session import materialize


def running_before(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with column ``name``: the sum of ``value`` over all rows before, in a unique order.

    Rows are written in ranges of the order. Each range adds up its own rows, and one
    number per range tells what the ranges before it hold.
    """
    ranged = df.withColumn("_value", value.cast("long")).repartitionByRange(*order)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_range").agg(F.sum("_value").alias("_total"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # A row per range of the shuffle: their number is a setting.
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum("_value").over(within), F.lit(0)))
        .drop("_value", "_range", "_offset")
    )
