"""Helpers that several of the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.session import materialize

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "[\\x20\\x09-\\x0D]+"
SLICE_BYTES = 4 << 20  # of texts that a task works on together, if not a single longer one


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def words_of(text: Column, separators: str = SPACES) -> Column:
    """The words between separators; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def written(df: DataFrame, label: str, **numbers: Column) -> tuple[DataFrame, dict]:
    """The frame written to the shared folder, and aggregates of it, taken on the way."""
    if not numbers:
        return materialize(df, label), {}
    seen = Observation()
    out = materialize(df.observe(seen, *[c.alias(n) for n, c in numbers.items()]), label)
    return out, seen.get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """One row in five is kept from training; rows without id are too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def byte_slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts in the column hold at most so many bytes together, if not one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        held = int(ends[begin - 1]) if begin else 0
        end = max(int(np.searchsorted(ends, held + size, "right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end
