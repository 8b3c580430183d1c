"""Contracts: required columns are there and not NULL, keys are unique, references lead somewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.operators.upsert import same_keys
from feedlake.session import broadcast_if_small, materialize


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]


def missing_fields(schema: StructType) -> Column:
    """Names of the required columns that are NULL in a row, in schema order."""
    checks = [F.when(F.col(c).isNull(), F.lit(c)) for c in required_columns(schema)]
    return F.array_compact(F.array(*checks))


def check_types(df: DataFrame, schema: StructType) -> None:
    """Raise where a declared column is absent or has another type."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [
        f.name for f in schema
        if f.name not in have or have[f.name].simpleString() != f.dataType.simpleString()
    ]
    if wrong:
        raise TypeError(f"columns absent or of another type: {', '.join(wrong)}")


def split_by_contract(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and rows that break it with column ``violations``."""
    tagged = df.withColumn("violations", missing_fields(schema))
    broken = F.size("violations") > 0
    return tagged.filter(~broken).drop("violations"), tagged.filter(broken)


def enforce(df: DataFrame, schema: StructType) -> DataFrame:
    """The same rows; the job fails at the first row that breaks the contract."""
    check_types(df, schema)
    missing = missing_fields(schema)
    message = F.concat(F.lit("required but NULL: "), F.array_join(missing, ", "))
    # The check is tied to a kept column, so that pruning cannot drop it.
    first = required_columns(schema)[0]
    return df.withColumn(
        first, F.when(F.size(missing) == 0, F.col(first)).otherwise(F.raise_error(message))
    )


def _split_by_keys(df: DataFrame, keys: list[str], bad: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows without one of the bad keys, and those with one; NULL is a key value like any other."""
    side = broadcast_if_small(materialize(bad.select(*keys).distinct(), "bad_keys"))
    broken = df.join(side, same_keys(df, side, keys), "left_semi")
    return df.join(side, same_keys(df, side, keys), "left_anti"), broken.withColumn("violations", F.array(F.lit(name)))


def split_unique(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key stands there once, and all rows of repeated keys with column ``violations``.

    Keys are counted before they are shuffled, and only repeated ones are joined.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _split_by_keys(df, keys, repeated, f"repeated: {', '.join(keys)}")


def split_references(
    df: DataFrame, columns: list[str], target: DataFrame, target_columns: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows whose reference is in ``target``, and those whose is not with column ``violations``.

    A reference with a NULL in it refers to nothing and keeps the contract. The distinct
    references are looked up, not the rows.
    """
    there = target.select(*[F.col(t).alias(c) for c, t in zip(columns, target_columns or columns)])
    asked = df.select(*columns).dropna().distinct()
    missing = asked.join(there, columns, "left_anti")
    return _split_by_keys(df, columns, missing, f"unknown: {', '.join(columns)}")
