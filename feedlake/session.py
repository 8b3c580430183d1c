"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import contextlib
import functools
import operator
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that results depend on: dates are UTC, JSON keeps the last of equal keys.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# Settings that only plans depend on.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# A write's shuffle files go when it ends, not when the driver happens to collect its garbage.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


class _Folders:
    """Folders made since the innermost `only_result` began, if one is running. Empty where it is sent to."""

    def __init__(self):
        self.var: ContextVar[list[str] | None] = ContextVar("folders", default=None)
        self.get, self.set, self.reset = self.var.get, self.var.set, self.var.reset

    def __reduce__(self):
        return type(self), ()


_FOLDERS = _Folders()


def build_session(app: str = "feedlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **PLAN_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on in a session somebody else made."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local master may do without
    that setting: there one machine holds everything.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="feedlake-")
    path = f"{base.rstrip('/')}/feedlake/{label}-{uuid.uuid4().hex}"
    made = _FOLDERS.get()
    if made is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which ends its lineage."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    with settings(spark, WRITE_CONF):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove what `materialize` wrote for these frames; neither they nor what reads them is used again."""
    for df in frames:
        _remove(df.sparkSession, df._folder)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def only_result(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What `make` gives, written; the folders that were made for it on the way are removed."""
    outer = _FOLDERS.set([])
    try:
        out = materialize(make(), label)
        *needed, kept = _FOLDERS.get()
    finally:
        _FOLDERS.reset(outer)
    for path in needed:
        _remove(spark, path)
    if _FOLDERS.get() is not None:
        _FOLDERS.get().append(kept)
    return out


def plan_bytes(df: DataFrame) -> int:
    """Spark's estimate of a frame's size; of a scan that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row holds; text counts in full."""

    def size(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "string":
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        if kind.startswith("array"):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        return F.lit(16)

    return functools.reduce(operator.add, [size(*column) for column in df.dtypes])


def broadcast_if_small(
    df: DataFrame, max_rows: int = 100_000, max_bytes: int = 32 << 20
) -> DataFrame:
    """Hint a broadcast only after counting that the side is within both bounds.

    Larger sides are returned as they are: the join is then a shuffled one and
    adaptive execution splits its skewed partitions.
    """
    size = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")
    ).first()
    if size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes:
        return F.broadcast(df)
    return df
