"""Named tables whose partitions are replaced all at once, by a switch of versions.

A table is a view on the table of one version, which the catalog holds like any other: its
partitions are folders, one more level of which names the version that wrote them. A change
writes new folders, enters them into the table of a new version together with the folders
that stay, and then lets the view show that one, which is a single step. Before it readers
see the old state, after it the new one, and who has begun to read keeps what was there. A
run that ends before the step leaves the old state, and its folders to `drop_versions`.

A table may be bucketed: rows with equal keys then lie in the bucket of one number in every
version, so changes are merged without a shuffle of the table. One writer at a time.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.operators.dedup import keep_first
from feedlake.session import WRITE_CONF, discard, materialize
from feedlake.session import settings as _settings
from feedlake.sources.tables import in_partitions

VERSION = "version"
# Joins on more than the bucket's columns use the buckets; a scan of buckets stays one.
MERGE_CONF = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def name_at(path: str) -> str:
    """The name of a table that is known by its folder."""
    return f"feedlake_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:20]}"


@dataclass(frozen=True)
class VersionedTable:
    """A table in the session's catalog, which has to outlast the session where the table does."""

    spark: SparkSession
    name: str
    path: str
    schema: StructType
    partition_by: tuple[str, ...]
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def _columns(self) -> list[str]:
        return [c for c in self.schema.fieldNames() if c not in self.partition_by] + [*self.partition_by]

    def _define(self, version: str) -> str:
        """An empty table of that version; returns its name."""
        name = f"{self.name}__{version}"
        kinds = {f.name: f.dataType.simpleString() for f in self.schema} | {VERSION: "string"}
        columns = ", ".join(f"`{c}` {kinds[c]}" for c in [*self._columns(), VERSION])
        quoted = lambda names: ", ".join(f"`{c}`" for c in names)
        clustered = (
            f"CLUSTERED BY ({quoted(self.bucket_by)}) SORTED BY ({quoted(self.bucket_by)}) INTO {self.buckets} BUCKETS"
            if self.bucket_by else ""
        )
        place = self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({quoted([*self.partition_by, VERSION])}) "
            f"{clustered} LOCATION '{place}'"
        )
        return name

    def _show(self, table: str) -> None:
        """The switch: from here on the view shows that table."""
        columns = ", ".join(f"`{c}`" for c in self.schema.fieldNames())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('table' = '{table}') AS SELECT {columns} FROM {table}")

    def create(self) -> VersionedTable:
        """The table, made empty where it is not there."""
        if not self.spark.catalog.tableExists(self.name):
            self._show(self._define(_new_version(0)))
        return self

    def current(self) -> str:
        """The name of the version's table that readers see."""
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('table')").first()["value"]

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def partitions(self, table: str | None = None) -> list[dict[str, str]]:
        """Columns and values, as text, of each partition and the version that wrote it."""
        shown = self.spark.sql(f"SHOW PARTITIONS {table or self.current()}").collect()
        return [dict((unquote(x) for x in p.split("=", 1)) for p in r[0].split("/")) for r in shown]

    def switch(self, rows: DataFrame, scope: DataFrame) -> None:
        """Let the partitions in `scope` hold nothing but `rows`, which lie in partitions of it.

        Rows may be read from the table: folders that are there are never written again.
        """
        old = self.current()
        new = self._define(_new_version(int(old.rsplit("__v", 1)[1].split("_")[0]) + 1))
        replaced = {tuple(r) for r in scope.select(*[_as_text(scope, c) for c in self.partition_by]).distinct().collect()}
        stay = [p for p in self.partitions(old) if tuple(p[c] for c in self.partition_by) not in replaced]
        for i in range(0, len(stay), 500):
            self.spark.sql(f"ALTER TABLE {new} ADD " + " ".join(f"PARTITION ({_spec(p)})" for p in stay[i : i + 500]))
        version = new.rsplit("__", 1)[1]
        with _settings(self.spark, {**WRITE_CONF, "spark.sql.parquet.compression.codec": "zstd"}):
            rows.select(*self._columns(), F.lit(version).alias(VERSION)).write.insertInto(new)
        self._show(new)

    def upsert(self, source: DataFrame, keys: list[str], order: list[Column]) -> None:
        """Rows of the table with no source row of the same key, and of each key the first source row by `order`.

        The keys hold all partition and bucket columns and are never NULL, which is an error. Only
        partitions of the source are read. Of these the table is read bucket by bucket: the source is
        shuffled to its buckets, the table is not.
        """
        first = keep_first(source, keys, order)
        given = F.when(_any_null(keys), F.raise_error(F.lit(f"NULL in {', '.join(keys)}"))).otherwise(F.lit(True))
        first = materialize(first.select(*self.schema.fieldNames()).filter(given), "source")
        with _settings(self.spark, MERGE_CONF):
            self.switch(self.merged(first, keys), first)
        discard(first)

    def merged(self, source: DataFrame, keys: list[str]) -> DataFrame:
        """The rows that an upsert of the source, unique by key, puts into its partitions."""
        old = self._beside(source)
        new = source.withColumn("_new", F.lit(True)).alias("new")
        same = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
        both = old.alias("old").join(new, same, "full_outer")
        return both.select(*[
            F.when(F.col("new._new"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in self.schema.fieldNames()
        ])

    def delete(self, gone: DataFrame, keys: list[str]) -> None:
        """Take out the rows with the listed keys."""
        gone = materialize(gone.select(*keys).distinct(), "gone")
        with _settings(self.spark, MERGE_CONF):
            old = self._beside(gone)
            same = [F.col(f"old.{k}") == F.col(f"gone.{k}") for k in keys]
            self.switch(old.alias("old").join(gone.alias("gone"), same, "left_anti"), gone)
        discard(gone)

    def _beside(self, rows: DataFrame) -> DataFrame:
        return in_partitions(self.read(), rows, [*self.partition_by])

    def drop_versions(self, keep: int = 2) -> None:
        """Forget all but the newest versions, and remove folders that none of them shows.

        Keep as many as readers may still be reading. Those of runs that did not end go too.
        """
        tables = sorted(t.name for t in self.spark.catalog.listTables(pattern=f"{self.name}__v*"))
        live = self.current()
        kept = {*tables[tables.index(live) + 1 - keep if tables.index(live) + 1 > keep else 0 : tables.index(live) + 1]}
        folders = {_folder(p) for t in kept for p in self.partitions(t)}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        levels = self.spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(["*"] * (len(self.partition_by) + 1)))
        for found in files.globStatus(levels) or []:
            parts = str(found.getPath().toString()).split("/")[-len(self.partition_by) - 1 :]
            if "=" in parts[-1] and "/".join(parts) not in folders:
                files.delete(found.getPath(), True)
        for t in tables:
            if t not in kept:
                self.spark.sql(f"DROP TABLE {t}")


def _new_version(number: int) -> str:
    """Versions are ordered by number; no two runs share one's folders."""
    return f"v{number:08d}_{uuid.uuid4().hex[:12]}"


def _as_text(df: DataFrame, column: str) -> Column:
    """A partition's value as the catalog shows it."""
    value = F.col(column).cast("string")
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")).alias(column)


def _spec(partition: dict[str, str]) -> str:
    quoted = {c: v.replace("\\", "\\\\").replace("'", "\\'") for c, v in partition.items()}
    return ", ".join(f"`{c}` = '{v}'" for c, v in quoted.items())


def _folder(partition: dict[str, str]) -> str:
    from feedlake.sources.tables import NULL_PARTITION, partition_folder

    return partition_folder({c: None if v == NULL_PARTITION else v for c, v in partition.items()})


def _any_null(keys: list[str]) -> Column:
    out = F.lit(False)
    for k in keys:
        out = out | F.col(k).isNull()
    return out
