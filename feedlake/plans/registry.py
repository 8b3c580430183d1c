"""What a query is: a function of session and data folder, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from feedlake.session import prepare

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None = None


def plain(df: DataFrame) -> DataFrame:
    """Times without zone, which compare alike in every client."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, TimestampType) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def query(run: Run, sql: str | None = None) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(run(prepare(spark), sf_dir))

    return Query(prepared, sql)
