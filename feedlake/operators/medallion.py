"""The batch job: staged records to bronze, silver and gold tables, and out of the vector table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake import schemas
from feedlake.functions.vectors import namespace
from feedlake.operators.bronze import KEY, dedup_bronze, load_bronze, newest_first
from feedlake.operators.contracts import missing_fields
from feedlake.operators.dedup import keep_first
from feedlake.operators.gold import build_gold
from feedlake.operators.metrics import counts_while
from feedlake.operators.silver import build_silver, clean_articles
from feedlake.operators.upsert import append_evolve, is_large, keep_first_of, repeated_keys, same_keys, with_keys
from feedlake.operators.vectors import STAMP_KEY, VECTOR_KEY, stamps_path, vector_table
from feedlake.profiles import CLUSTER, Profile
from feedlake.session import broadcast_if_small, discard, materialize
from feedlake.sources.staging import read_staging
from feedlake.sources.tables import (
    append_table, create_table, date_slice, delete_from_table, has_files, in_partitions, null_partitions, read_table,
    replace_partitions, replace_rows, upsert_table,
)


def run_medallion(
    spark: SparkSession, staging_path: str, root: str, date: str | None = None,
    profile: Profile = CLUSTER, as_of: Column | None = None, append_only: bool = False,
    vector_path: str | None = None,
) -> dict[str, int]:
    """Load one staged folder into the tables under ``root``; see ``load_records``."""
    bronze = load_bronze(read_staging(spark, staging_path), date)
    return load_records(spark, bronze, root, profile, as_of, append_only, vector_path, date, staged=True)


def load_records(
    spark: SparkSession, bronze: DataFrame, root: str, profile: Profile = CLUSTER,
    as_of: Column | None = None, append_only: bool = False, vector_path: str | None = None,
    date: str | None = None, staged: bool = False,
) -> dict[str, int]:
    """Run all three stages for new bronze rows; returns how many rows each stage put out.

    Rows that break a stage's contract go to its quarantine table and are counted
    under ``quarantined``. Bronze keeps the newest record of an article and date. Silver and
    gold follow the change: the contents that the new records have, and those that they had
    before, are ranked again, and the articles and chunks of these contents are replaced, nothing
    else. Superseded articles go, and so do chunks that an article no longer has, with their
    vectors in ``vector_path``. A chunk whose text is the same keeps its stamp. Runs over parts
    of the input, in any order, therefore end in the tables that one run over all of it gives,
    and a repeated run, also of one that failed, changes nothing more.

    ``append_only`` adds rows as they are. With ``date`` silver and gold are built anew for that
    date, from all its records. Rows that are ``staged`` lie in files that stay: many are read again
    rather than copied, and of several records of an article and date the newest counts.
    """
    run = _Run(spark, root)
    large = is_large(bronze)
    if staged and large:
        bronze = keep_first_of(bronze, KEY, newest_first(), repeated_keys(bronze.select(*KEY), KEY))
    elif staged:
        bronze = dedup_bronze(bronze)
    source = run.checked(bronze, schemas.BRONZE, "bronze", written=staged and large)
    if append_only:
        append_table(source, f"{root}/bronze", schemas.BRONZE_PARTITIONS)
        stored = read_table(spark, f"{root}/bronze", schemas.BRONZE)
        new = date_slice(source if profile.dedup_per_date else stored, date)
        dates = materialize(new.select("ingestion_date").distinct(), "dates")
        silver = run.checked(
            build_silver(in_partitions(stored, dates, ["ingestion_date"]), profile, as_of), schemas.SILVER, "silver"
        )
        append_table(silver, f"{root}/silver", schemas.SILVER_PARTITIONS)
        gold = run.checked(build_gold(silver, profile, as_of), schemas.GOLD, "gold")
        append_table(gold, f"{root}/gold", schemas.GOLD_PARTITIONS)
        return run.counts
    if date:
        _upsert_bronze(spark, root, source)
        _rebuild_date(run, profile, as_of, vector_path, date)
    else:
        _follow_change(run, source, profile, as_of, vector_path)
    return run.counts


class _Run:
    """Counts what the stages of a run put out, and puts aside what breaks their contracts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.counts = spark, root, {"quarantined": 0}
        self.folders: dict[str, DataFrame] = {}

    def checked(self, df: DataFrame, schema: StructType, name: str, written: bool = False) -> DataFrame:
        """The rows that keep the contract. All are written once, and counted meanwhile, unless they are ``written``."""
        marked = df.withColumn("violations", missing_fields(schema))
        counts = {"rows": F.count(F.lit(1)), "broken": F.count_if(F.size("violations") > 0)}
        kept = [marked]
        if written:
            n = marked.agg(*[c.alias(k) for k, c in counts.items()]).first().asDict()
        else:
            n = counts_while(marked, lambda rows: kept.append(materialize(rows, name)), **counts)
            self.folders[name] = kept[-1]
        n_bad = n["broken"]
        if n_bad:
            bad = kept[-1].filter(F.size("violations") > 0)
            keys = [c for c in df.columns if df.schema[c].dataType.typeName() != "map"]
            bad = bad.withColumn("violations", F.array_join("violations", ","))
            upsert_table(self.spark, f"{self.root}/quarantine/{name}", bad, [*keys, "violations"], ["ingestion_date"])
        self.counts["quarantined"] += n_bad
        self.counts[name] = n["rows"] - n_bad
        good = kept[-1].filter(F.size("violations") == 0) if n_bad else kept[-1]
        return good.drop("violations")

    def drop(self, name: str) -> None:
        """Remove what was written for a stage whose rows are not read again."""
        if name in self.folders:
            discard(self.folders.pop(name))


def _upsert_bronze(spark: SparkSession, root: str, source: DataFrame) -> None:
    upsert_table(
        spark, f"{root}/bronze", source, KEY, schemas.BRONZE_PARTITIONS, newest_first(), newest=True, written=True
    )


def _rebuild_date(run: _Run, profile: Profile, as_of: Column | None, vector_path: str | None, date: str) -> None:
    """Silver and gold of one date from all its bronze rows."""
    spark, root = run.spark, run.root
    stored = date_slice(read_table(spark, f"{root}/bronze", schemas.BRONZE), date)
    dates = materialize(stored.select("ingestion_date").distinct(), "dates")
    silver = run.checked(build_silver(stored, profile, as_of), schemas.SILVER, "silver")
    gold = run.checked(build_gold(silver, profile, as_of), schemas.GOLD, "gold")
    _replace_dates(spark, f"{root}/silver", silver, schemas.SILVER, schemas.SILVER_PARTITIONS, dates)
    old = None
    if has_files(spark, f"{root}/gold"):
        before = in_partitions(read_table(spark, f"{root}/gold", schemas.GOLD), dates, ["ingestion_date"])
        old = materialize(before.select(*_CHUNK), "old_gold")
        gold = _follow_stamps(spark, f"{root}/gold", old, gold)
    _replace_dates(spark, f"{root}/gold", gold, schemas.GOLD, schemas.GOLD_PARTITIONS, dates)
    if old is not None and vector_path:
        _forget_vectors(spark, f"{root}/gold", vector_path, old, gold)


def _follow_change(
    run: _Run, source: DataFrame, profile: Profile, as_of: Column | None, vector_path: str | None
) -> None:
    """Replace the articles and chunks of the contents that new records have or had, and no others.

    A narrow table tells for each content the records that have it, so that their ranks need no
    texts. Only texts of the winners are read that the run does not bring itself. Bronze is
    written last: until then the old contents of the records are known, so a run that fails is
    repaired by its repetition.
    """
    spark, root = run.spark, run.root
    create_table(spark, f"{root}/bronze", schemas.BRONZE, schemas.BRONZE_PARTITIONS)
    stored = read_table(spark, f"{root}/bronze", schemas.BRONZE)
    _known_contents(spark, root, stored, profile)
    # What bronze has of these records, and will have.
    named = materialize(source.select(*KEY), "named")
    keys = broadcast_if_small(named)
    source_rows = null_partitions(source, schemas.BRONZE_PARTITIONS)  # as they are read back
    near = in_partitions(stored, named, ["ingestion_date"])
    before = materialize(with_keys(near, keys, KEY), "records_before")
    both = append_evolve(before, source_rows)
    if is_large(both):
        after = keep_first_of(both, KEY, newest_first(), repeated_keys(before.select(*KEY).unionByName(named), KEY))
    else:
        after = dedup_bronze(both)
    cleaned = materialize(clean_articles(after, profile, as_of), "cleaned")
    had, have = (_contents(rows) for rows in (clean_articles(before, profile, as_of), cleaned))
    had, have = materialize(had, "had"), materialize(have, "have")
    discard(before)
    # Their contents, old and new, and all records with one of them.
    within = ["content_hash", "ingestion_date"] if profile.dedup_per_date else ["content_hash"]
    shards = had.select(_SHARD).unionByName(have.select(_SHARD))
    affected = materialize(had.select(*within).unionByName(have.select(*within)).distinct(), "affected")
    known = in_partitions(read_table(spark, f"{root}/contents", schemas.CONTENTS), shards, [_SHARD])
    few = broadcast_if_small(affected)
    known = known.join(few, same_keys(known, few, within), "left_semi")
    others = known.join(keys, same_keys(known, keys, KEY), "left_anti")
    ranked = materialize(others.select(*have.columns).unionByName(have), "contents")
    order = (
        [F.col("ingested_at").desc(), F.col("article_id").asc()] if profile.dedup_per_date
        else [F.col("ingested_at"), F.col("article_id")]
    )
    winners = materialize(keep_first(ranked, within, order), "winners")
    # Texts of winners that this run does not bring. Few that it brings do not win.
    losers = materialize(have.select(*KEY).join(winners.select(*KEY), KEY, "left_anti"), "losers")
    lost = broadcast_if_small(losers)
    brought = cleaned.join(lost, same_keys(cleaned, lost, KEY), "left_anti")
    rest = materialize(winners.join(keys, same_keys(winners, keys, KEY), "left_anti"), "unread")
    unread = in_partitions(stored, rest, schemas.BRONZE_PARTITIONS)
    read = clean_articles(unread.join(broadcast_if_small(rest.select(*KEY)), KEY, "left_semi"), profile, as_of)
    silver = run.checked(brought.unionByName(read).drop("ingested_at"), schemas.SILVER, "silver")
    discard(cleaned, affected, winners, losers, rest)
    gold = run.checked(build_gold(silver, profile, as_of), schemas.GOLD, "gold")
    # Every record of these contents leaves silver and gold, and the winners come in.
    leave = materialize(ranked.unionByName(had).select(*KEY, "region", "language").distinct(), "leave")
    discard(ranked)
    replace_rows(spark, f"{root}/silver", schemas.SILVER, leave, silver, KEY, schemas.SILVER_PARTITIONS)
    run.drop("silver")
    held = in_partitions(_table(spark, f"{root}/gold", schemas.GOLD, schemas.GOLD_PARTITIONS), leave, schemas.GOLD_PARTITIONS)
    old = materialize(with_keys(held, leave, KEY).select(*_CHUNK), "old_gold")
    stamped = _follow_stamps(spark, f"{root}/gold", old, gold)
    if stamped is not gold:
        run.drop("gold")
    replace_rows(spark, f"{root}/gold", schemas.GOLD, leave, stamped, KEY, schemas.GOLD_PARTITIONS)
    if vector_path:
        _forget_vectors(spark, f"{root}/gold", vector_path, old, stamped)
    discard(old, leave, *([stamped] if stamped is not gold else []))
    run.drop("gold")
    replace_rows(spark, f"{root}/contents", schemas.CONTENTS, had, have, KEY, [_SHARD])
    _upsert_bronze(spark, root, source)
    discard(had, have, named)
    run.drop("bronze")


_SHARD = "shard"
_CHUNK = ["chunk_id", "ingestion_date", "region", "chunk_text", "embedded_at"]


def _table(spark: SparkSession, path: str, schema: StructType, partition_by: list[str]) -> DataFrame:
    create_table(spark, path, schema, partition_by)
    return read_table(spark, path, schema)


def _contents(cleaned: DataFrame) -> DataFrame:
    """Which record has which content; the table of them is cut by the content's first digit."""
    return cleaned.select(
        *KEY, "region", "language", "content_hash", "ingested_at", F.substring("content_hash", 1, 1).alias(_SHARD)
    )


def _known_contents(spark: SparkSession, root: str, stored: DataFrame, profile: Profile) -> None:
    """The table of contents, made from bronze where a lake has none yet."""
    path = f"{root}/contents"
    create_table(spark, path, schemas.CONTENTS, [_SHARD])
    if not has_files(spark, path) and has_files(spark, f"{root}/bronze"):
        append_table(_contents(clean_articles(stored, profile)), path, [_SHARD])


def _follow_stamps(spark: SparkSession, gold_path: str, old: DataFrame, gold: DataFrame) -> DataFrame:
    """New chunks with the stamps of those of the same text; other stamps go.

    They go before gold is written, so that a run that ends here embeds a chunk once more
    rather than never. Without old chunks there are none to keep or drop.
    """
    if old.isEmpty():
        return gold
    gold = materialize(_keep_stamps(gold, old), "gold")
    _forget_stamps(spark, gold_path, old, gold)
    return gold


def _replace_dates(
    spark: SparkSession, path: str, rows: DataFrame, schema: StructType, partition_by: list[str],
    dates: DataFrame,
) -> None:
    scope = rows.select(*partition_by)
    if has_files(spark, path):
        held = in_partitions(read_table(spark, path, schema), dates, ["ingestion_date"])
        scope = scope.unionByName(held.select(*partition_by))
    replace_partitions(spark, path, rows, partition_by, materialize(scope.distinct(), "scope"))


def _keep_stamps(gold: DataFrame, old: DataFrame) -> DataFrame:
    """Chunks that were there before with the same text stay embedded."""
    stamped = old.filter(F.col("embedded_at").isNotNull()).groupBy(
        "chunk_id", "ingestion_date", "chunk_text"
    ).agg(F.max("embedded_at").alias("_stamp"))
    joined = gold.join(stamped, ["chunk_id", "ingestion_date", "chunk_text"], "left")
    return joined.withColumn("embedded_at", F.coalesce("embedded_at", "_stamp")).select(*gold.columns)


def _forget_stamps(spark: SparkSession, gold_path: str, old: DataFrame, gold: DataFrame) -> None:
    """Chunks whose text changes, or that go, are not embedded any more."""
    same = [*STAMP_KEY, "chunk_text"]
    changed = old.join(gold.select(*same), same, "left_anti").select(*STAMP_KEY)
    delete_from_table(spark, stamps_path(gold_path), changed, STAMP_KEY, schemas.GOLD_PARTITIONS)


def _forget_vectors(
    spark: SparkSession, gold_path: str, vector_path: str, old: DataFrame, gold: DataFrame
) -> None:
    """Take out the vectors of chunks that are in no date's gold any more."""
    gone = materialize(old.join(gold.select("chunk_id"), "chunk_id", "left_anti"), "gone_chunks")
    if not gone.limit(1).count():
        return
    everywhere = read_table(spark, gold_path, schemas.GOLD).select("chunk_id").join(
        broadcast_if_small(gone.select("chunk_id").distinct()), "chunk_id", "left_semi"
    )
    vectors = gone.join(everywhere, "chunk_id", "left_anti").select(
        namespace(F.col("region")).alias("namespace"), F.col("chunk_id").alias("id")
    )
    vector_table(spark, vector_path).delete(vectors, VECTOR_KEY)
