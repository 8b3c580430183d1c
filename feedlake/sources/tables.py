"""Partitioned parquet tables: create, append, read, and rewrite by partition.

A table has one writer at a time. A rewrite first writes the new rows to the
shared folder, so the table is never read and replaced by the same job, and
running it again after a failure gives the same result. Partitions are replaced
one by one: until a rewrite ends, a row that changes its partition may be in both.

Spark writes an empty partition value as NULL, so both count as NULL here.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from feedlake.operators.upsert import (
    append_evolve, is_large, keep_first_of, mark_embedded, repeated_keys, same_keys, upsert_newest,
)
from feedlake.session import WRITE_CONF, broadcast_if_small, discard, materialize, plan_bytes, settings

# So many partitions are named in a filter; the values of more are joined.
MAX_NAMED = 1_000

# A rewrite of more bytes is done in so many parts at most, so that they do not all lie there twice.
PART_BYTES, MAX_PARTS = 64 << 20, 8

# How Spark names partition folders.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def _write(df: DataFrame, path: str, partition_by: list[str], mode: str) -> None:
    # The hint lets adaptive execution split a partition that holds most rows
    # and merge small ones, so file sizes do not follow the skew.
    writer = df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with settings(df.sparkSession, WRITE_CONF):
        writer.partitionBy(*partition_by).option("compression", "zstd").parquet(path)


def create_table(spark: SparkSession, path: str, schema: StructType, partition_by: list[str]) -> None:
    """An empty partitioned table, or the one that is there. Read a new one with its schema."""
    if not _folder(spark, path)[2]:
        # No rows make no partition folders, so this adds no file to a table.
        spark.createDataFrame([], schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Add rows as they are; new columns are allowed."""
    _write(df, path, partition_by, "append")


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, date: str | None = None
) -> DataFrame:
    """Scan a table, with a date only that date's partitions; an empty date means all."""
    if schema is None:
        df = spark.read.option("mergeSchema", "true").parquet(path)
    else:
        df = spark.read.schema(schema).parquet(path)
    return date_slice(df, date)


def date_slice(df: DataFrame, date: str | None) -> DataFrame:
    return df.filter(F.col("ingestion_date") == F.to_date(F.lit(date))) if date else df


def partition_folder(values: dict[str, object]) -> str:
    """The folder of a partition, as Spark names it."""

    def escape(value: object) -> str:
        if value is None or value == "":
            return NULL_PARTITION
        return "".join(f"%{ord(c):02X}" if c < " " or c in ESCAPED else c for c in str(value))

    return "/".join(f"{escape(k)}={escape(v)}" for k, v in values.items())


def null_partitions(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Empty partition values as NULL, as they are read back."""
    texts = [c for c in partition_by if isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in texts}) if texts else df


def in_partitions(df: DataFrame, partitions: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``df`` in the listed partitions.

    A literal filter prunes the scan, so a few touched partitions of a large table
    are the only ones opened. Beyond ``MAX_NAMED`` the first column, if its values
    are few enough, still prunes, and the rest is a join.
    """
    wanted = partitions.select(*columns).distinct()
    rows = wanted.limit(MAX_NAMED + 1).collect()
    if len(rows) <= MAX_NAMED:
        if not rows:
            return df.filter(F.lit(False))
        return df.filter(_any_of([_named(columns, row) for row in rows]))
    first = columns[:1]
    values = wanted.select(*first).distinct().limit(MAX_NAMED + 1).collect()
    if len(values) <= MAX_NAMED:
        df = df.filter(_any_of([_named(first, row) for row in values]))
    side = broadcast_if_small(wanted)
    return df.join(side, same_keys(df, side, columns), "left_semi")


def _named(columns: list[str], row: tuple) -> Column:
    tests = [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(columns, row)]
    return functools.reduce(operator.and_, tests)


def _any_of(tests: list[Column]) -> Column:
    """One of the tests, as a balanced tree: a long chain is too deep to analyse."""
    while len(tests) > 1:
        tests = [functools.reduce(operator.or_, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]


def evolved_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """The given columns, and those the table has besides; the types given win."""
    stored = spark.read.option("mergeSchema", "true").parquet(path).schema
    known = set(schema.fieldNames())
    return StructType([*schema.fields, *[f for f in stored.fields if f.name not in known]])


def _folder(spark: SparkSession, path: str) -> tuple:
    """A folder, its file system, and whether it is there."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return root, files, files.exists(root)


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether the table is there and has a partition; only its top folder is listed."""
    root, files, there = _folder(spark, path)
    return there and any("=" in f.getPath().getName() for f in files.listStatus(root))


def _remove(spark: SparkSession, path: str, partitions: DataFrame) -> None:
    """Take out the folders of partitions; no data is read or written."""
    root, files, _ = _folder(spark, path)
    for row in partitions.coalesce(1).toLocalIterator():
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(root, partition_folder(row.asDict())), True)


# Of some rows those of the partitions that are rewritten together.
Only = Callable[[DataFrame], DataFrame]


def _parts(
    spark: SparkSession, path: str, touched: DataFrame, apart: list[str], rows: DataFrame | None
) -> list[tuple[DataFrame, Only]]:
    """The touched partitions in parts that differ in the columns ``apart``, more of them the more there is to write."""
    whole = [(touched, lambda df: df)]
    folders = touched.limit(MAX_NAMED + 1).collect()
    if not apart or len(folders) > MAX_NAMED:
        return whole
    root, files, _ = _folder(spark, path)
    size = 0 if rows is None else plan_bytes(rows)
    for row in folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root, partition_folder(row.asDict()))
        if size <= PART_BYTES * MAX_PARTS and files.exists(folder):
            size += files.getContentSummary(folder).getLength()
    values = list(dict.fromkeys(tuple(row[c] for c in apart) for row in folders))
    n = min(len(values), MAX_PARTS, -(-size // PART_BYTES))
    if n <= 1:
        return whole
    tests = [_any_of([_named(apart, v) for v in values[i::n]]) for i in range(n)]
    return [(touched.filter(t), lambda df, t=t: df.filter(t)) for t in tests]


def _rewrite(
    target: DataFrame, path: str, partition_by: list[str], touched: DataFrame,
    change: Callable[[DataFrame, Only], DataFrame | None], apart: list[str] | None = None,
    rows: DataFrame | None = None,
) -> None:
    """Replace the rows of the touched partitions by ``change`` of them.

    Where these partitions have no rows yet, nothing is read that is replaced: the new rows are
    written at once. So are the new ``rows`` where ``change`` gives None, which says that no row
    that is there changes. Partitions that differ in the columns ``apart`` do not depend on each
    other.
    """
    spark = target.sparkSession
    touched = materialize(touched.select(*partition_by).distinct(), "touched")
    for part, only in _parts(spark, path, touched, apart or [], rows):
        affected = in_partitions(target, part, partition_by)
        empty = affected.isEmpty()
        changed = change(target.limit(0) if empty else affected, only)
        if changed is None and rows is not None:
            changed, empty = append_evolve(target.limit(0), only(rows)), True
        if changed is None:
            continue
        if empty:
            _write(changed, path, partition_by, "append")
            continue
        staged = materialize(changed, "rewrite")
        replace_partitions(spark, path, staged, partition_by, part)
        discard(staged)
    discard(touched)


def replace_partitions(
    spark: SparkSession, path: str, rows: DataFrame, partition_by: list[str], scope: DataFrame
) -> None:
    """Let the partitions in ``scope`` hold nothing but ``rows``, which are written elsewhere.

    Dynamic overwrite leaves a partition alone that gets no rows, so those are removed.
    """
    _write(rows, path, partition_by, "overwrite")
    kept = rows.select(*partition_by).distinct()
    gone = scope.join(kept, same_keys(scope, kept, partition_by), "left_anti")
    _remove(spark, path, gone)


def upsert_table(
    spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: list[str],
    order: list[Column] | None = None, newest: bool = False, written: bool = False,
) -> None:
    """Upsert rows by key into the table at ``path``; only touched partitions are rewritten.

    Touched are the source's partitions and those where the table has one of its
    keys: a row whose partition changes leaves the old one. To find these, only
    key and partition columns of the table are read, and only of the source's
    values where a partition column is part of the key; a key that holds all of
    them needs no search. With ``newest`` the first row by ``order`` wins on
    either side, else the source wins. NULL is a key value like any other. Columns
    that only the table has stay, NULL in new rows. The source is read twice, so
    it is written out first unless it is ``written`` or the same whenever it is read.
    """
    source = null_partitions(source, partition_by)
    made = []
    if not written:
        source = materialize(source, "source")
        made.append(source)
    create_table(spark, path, source.schema, partition_by)
    schema = evolved_schema(spark, path, source.schema) if has_files(spark, path) else source.schema
    target = read_table(spark, path, schema)
    # What tells the partitions is narrow, so the source's texts are read once only.
    named = materialize(source.select(*dict.fromkeys([*keys, *partition_by])), "named")
    touched = named.select(*partition_by)
    in_key = [c for c in partition_by if c in keys]
    if len(in_key) < len(partition_by):
        near = in_partitions(target, named, in_key) if in_key else target
        near = near.select(*keys, *[c for c in partition_by if c not in keys])
        wanted = named.select(*keys).distinct()
        located = near.join(wanted, same_keys(near, wanted, keys), "left_semi")
        touched = touched.unionByName(located.select(*partition_by))
    if order is not None and not newest:
        made.append(repeated_keys(named, keys))
        source = keep_first_of(source, keys, order, made[-1])

    def change(affected: DataFrame, only: Only) -> DataFrame | None:
        if not newest:
            return _without(affected, only(named), keys, only(source), made)
        if not is_large(affected) and not is_large(source):
            return upsert_newest(affected, only(source), keys, order)
        made.append(repeated_keys(affected.select(*keys).unionByName(only(named).select(*keys)), keys))
        if made[-1].isEmpty():
            return None
        return keep_first_of(append_evolve(affected, only(source)), keys, order, made[-1])

    _rewrite(target, path, partition_by, touched, change, in_key, source)
    discard(named, *made)


def _without(
    affected: DataFrame, gone: DataFrame, keys: list[str], rows: DataFrame | None, made: list[DataFrame]
) -> DataFrame | None:
    """The affected rows but those with a key in ``gone``, and new rows; None if none of them goes.

    In a large table the keys are searched first, without other columns, so that few rows are
    shuffled where few go.
    """
    wanted = gone.select(*keys).distinct()
    if not is_large(affected):
        few = broadcast_if_small(wanted)
        rest = affected.join(few, same_keys(affected, few, keys), "left_anti")
        return rest if rows is None else append_evolve(rest, rows)
    found = affected.select(*keys).join(wanted, same_keys(affected, wanted, keys), "left_semi").distinct()
    made.append(materialize(found, "found_keys"))
    if made[-1].isEmpty():
        return None
    few = broadcast_if_small(made[-1])
    rest = affected.join(few, same_keys(affected, few, keys), "left_anti")
    return rest if rows is None else append_evolve(rest, rows)


def replace_rows(
    spark: SparkSession, path: str, schema: StructType, gone: DataFrame, rows: DataFrame, keys: list[str],
    partition_by: list[str],
) -> None:
    """Take the rows with the keys of `gone` out of its partitions, and put `rows` in.

    Only partitions of either are read and rewritten; `gone` carries their columns.
    """
    create_table(spark, path, schema, partition_by)
    target = read_table(spark, path, schema)
    gone = materialize(null_partitions(gone.select(*dict.fromkeys([*keys, *partition_by])), partition_by), "gone")
    rows = null_partitions(rows.select(*schema.fieldNames()), partition_by)
    made = [gone]

    def change(affected: DataFrame, only: Only) -> DataFrame | None:
        return _without(affected, gone, keys, only(rows), made)

    touched = gone.select(*partition_by).unionByName(rows.select(*partition_by))
    _rewrite(target, path, partition_by, touched, change, partition_by, rows)
    discard(*made)


def stamp_table(
    spark: SparkSession, path: str, schema: StructType, done: DataFrame, partition_by: list[str]
) -> None:
    """Set ``embedded_at`` of the listed chunks; ``done`` carries their partition columns."""
    target = read_table(spark, path, evolved_schema(spark, path, schema))
    done = null_partitions(done, partition_by)
    stamps = done.select("chunk_id", "embedded_at")
    _rewrite(target, path, partition_by, done, lambda rows, _: mark_embedded(rows, stamps), partition_by)


def delete_from_table(
    spark: SparkSession, path: str, gone: DataFrame, keys: list[str], partition_by: list[str]
) -> None:
    """Take the rows with the listed keys out; ``gone`` carries their partition columns."""
    if not has_files(spark, path):
        return
    gone = materialize(null_partitions(gone, partition_by), "gone")
    if gone.isEmpty():
        return
    target = read_table(spark, path, spark.read.option("mergeSchema", "true").parquet(path).schema)
    made = [gone]
    _rewrite(
        target, path, partition_by, gone, lambda rows, _: _without(rows, gone, keys, None, made), partition_by
    )
    discard(*made)
