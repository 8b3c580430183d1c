"""Runs a query on Spark and its SQL on DuckDB, and compares the rows."""

from __future__ import annotations

import collections
import os

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    return str(value) if not isinstance(value, (int, float, str, bool)) else value


def rows(frame: pd.DataFrame) -> collections.Counter:
    frame = frame[sorted(frame.columns)]
    columns = [
        [_cell(v) for v in (s.astype(str).where(s.notna(), None) if "datetime" in str(s.dtype) else s)]
        for _, s in frame.items()
    ]
    return collections.Counter(zip(*columns))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    ours, theirs = rows(spark_frame), rows(sql_frame)
    if ours == theirs:
        return None
    return (
        f"{len(spark_frame)} rows != {len(sql_frame)} rows; "
        f"only spark {list((ours - theirs).items())[:2]}; "
        f"only sql {list((theirs - ours).items())[:2]}"
    )[:3000]
