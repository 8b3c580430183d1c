"""Row counts taken while a stage is written, without running it again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def count_while(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on the frame and return how many rows went through."""
    return counts_while(df, write, rows=F.count(F.lit(1)))["rows"]


def counts_while(df: DataFrame, write: Callable[[DataFrame], None], **counts: Column) -> dict[str, int]:
    """Run ``write`` on the frame and return the named aggregates of the rows that went through."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(name) for name, c in counts.items()]))
    return seen.get
