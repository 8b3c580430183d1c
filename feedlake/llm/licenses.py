"""License scans by diagonal voting.

All rolling word pairs of a document are hashed and joined with the places of the
same pairs in license templates. A hit votes for the diagonal, the difference of
its two places. A phrase that stands word by word fills one diagonal; a changed
or missing word moves the rest to a neighbouring one, so neighbours are merged.
Spans of about the template's length are verified wherever a vote begins one, so votes
around a template never hide it: one counts if it holds enough of the template.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.llm.common import let, lower_ascii, words_of
from feedlake.session import broadcast_if_small

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
MIN_COVERAGE = 0.6  # of a template's word pairs
DRIFT = 3  # words that may be missing or extra in a span
START = 0  # stands before the first pair of every document; no pair hashes to it


class Template(NamedTuple):
    label: str
    phrase: str  # words in lower case with single spaces
    exact: bool = False


BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
TEMPLATES = BASE + (
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("gpl", "licensed under the gnu general public license version"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu"),
    Template("bsd", "redistribution and use in source and binary forms are permitted"),
    Template("mpl", "subject to the terms of the mozilla public license"),
    Template("cc-by", "licensed under a creative commons attribution"),
    Template("reserved", "may not be reproduced without permission of the copyright holder"),
)


def _pairs(words: Column) -> Column:
    """Hashes of all neighbouring words, in order."""
    return F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: let(
            F.xxhash64(w, F.get(words, i + 1)),
            lambda h: F.when(h == START, F.lit(1).cast("long")).otherwise(h),
        ),
    )


def template_places(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(hash, template, label, exact, place, n_pairs): every pair of every template.

    A template needs two words or more.
    """
    rows = [(i, t.label, t.exact, t.phrase.split(" ")) for i, t in enumerate(templates)]
    if any(len(r[3]) < 2 for r in rows):
        raise ValueError("a template needs two words or more")
    frame = spark.createDataFrame(rows, "template int, label string, exact boolean, words array<string>")
    return frame.select(
        "template", "label", "exact",
        (F.size("words") - 1).alias("n_pairs"),
        F.posexplode(_pairs(F.col("words"))).alias("place", "hash"),
    )


def scan_licenses(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id",
    text_col: str = "text", min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    `n_base` counts all places where an exact template's words stand one after the
    other; `first_word` and `last_word` are the smallest and largest start among
    them, null if there is none. `labels` also holds those of templates found in
    part; both lists are sorted and comma-joined, empty if nothing was found. The
    score is the largest share of a template that was found, 0 if none. A-Z count as small
    letters, no others do. A null or empty text has no words; texts of any length are scanned
    whole, repeated rows give a row each, other columns are ignored, and an empty table gives no rows.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(f"`{id_col}`").alias("_id"),
        F.explode(
            F.array(
                let(
                    words_of(lower_ascii(F.col(f"`{text_col}`")), SEPARATORS),
                    lambda w: F.struct(
                        F.size(w).cast("long").alias("n"),
                        F.concat(F.array(F.lit(START).cast("long")), _pairs(w)).alias("h"),
                    ),
                )
            )
        ).alias("_w"),
    )
    wide = rows.select(
        "_row", "_id", F.col("_w.n").alias("_n"), F.posexplode("_w.h").alias("_pos", "_hash")
    )
    places = template_places(docs.sparkSession, templates)
    # Each document keeps one row that no template has, with its number of words.
    start = docs.sparkSession.range(1).select(
        F.lit(-1).alias("template"), F.lit(None).cast("string").alias("label"),
        F.lit(False).alias("exact"), F.lit(1).alias("n_pairs"), F.lit(0).alias("place"),
        F.lit(START).cast("long").alias("hash"),
    )
    votes = wide.join(
        broadcast_if_small(places.unionByName(start)), F.col("_hash") == F.col("hash")
    ).select(
        "_row", "_id", "_n", "template", "label", "exact", "n_pairs", "place",
        (F.col("_pos") - 1).alias("pos"),
        (F.col("_pos") - 1 - F.col("place")).alias("diagonal"),
    )
    # All steps below need a document's votes together: one shuffle serves them.
    votes = votes.repartition("_row")
    # A span begins at any vote and is as long as its template, with some room for drift: of the
    # votes in it those on the same or a neighbouring diagonal count, each place once.
    longest = max(len(t.phrase.split(" ")) for t in templates) + DRIFT
    ahead = Window.partitionBy("_row", "template").orderBy("pos").rangeBetween(0, longest)
    room = F.when(F.col("exact"), 0).otherwise(DRIFT)
    near = F.filter(
        F.collect_list(F.struct("pos", "place", "diagonal")).over(ahead),
        lambda v: (v["pos"] < F.col("pos") + F.col("n_pairs") + room) & (F.abs(v["diagonal"] - F.col("diagonal")) <= room),
    )
    spans = votes.withColumn("found", F.size(F.array_distinct(F.transform(near, lambda v: v["place"])))).withColumnRenamed("pos", "first")
    share = F.col("found") / F.col("n_pairs")
    whole = F.col("exact") & (F.col("place") == 0) & (F.col("found") == F.col("n_pairs"))
    verified = (F.col("template") >= 0) & F.when(F.col("exact"), whole).otherwise(share >= min_coverage)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return spans.groupBy("_row", "_id", "_n").agg(
        F.count(F.when(verified & whole, 1)).alias("n_base"),
        F.min(F.when(verified & whole, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(verified & whole, F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(verified & whole, F.col("label"))).alias("base_labels"),
        joined(F.when(verified, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(verified, share)), F.lit(0.0)).alias("score"),
    ).select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_words"),
        "n_base", "first_word", "last_word", "base_labels", "labels", "score",
    )
