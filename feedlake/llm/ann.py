"""Nearest neighbours by multi-index hashing.

A rotation is learnt, on a bounded sample, that brings vectors near the corners of a
cube; the signs of the rotated components are their binary codes. Every vector is
indexed, in the partition where it lies, under each substring of its code. Two codes
within a Hamming radius r agree within r // substrings bits in at least one substring
(pigeonhole), so probing all such values of each substring finds every code within the
radius. Those are ranked by their distance on the original vectors.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.session import shared_dir

SAMPLE_ROWS = 4_096  # vectors on which rotation and radius are learnt
ITERATIONS = 30
SUBSTRING_BITS = 8
RECALL = 0.98  # of the sample's true neighbours must lie within the radius
QUERY_BLOCK = 4_096  # queries searched together; their vectors are sent to all tasks
CHUNK_ROWS = 16_384


class Index(NamedTuple):
    """What codes are made by: the centre, the rotation, and the radius to search."""

    centre: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bits of the vectors, padded to whole substrings, as bytes."""
        return np.packbits((x - self.centre) @ self.rotation > 0, axis=1)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component finite."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda v: v != 0), F.lit(False))


def vectors_of(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    return table.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v")
    ).filter(F.col("id").isNotNull() & usable(F.col("v")))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a[:, None, :] - b[None]) ** 2).sum(axis=2))


def _differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def learn(sample: np.ndarray, k: int, recall: float = RECALL) -> Index:
    """Principal axes, then a rotation by which components come near to plus or minus one.

    Signs and rotation are fitted in turns. The radius is the smallest that holds the
    given share of true neighbours in the sample; those of the whole table are nearer.
    """
    centre = sample.mean(axis=0)
    x = sample - centre
    axes = np.linalg.svd(x, full_matrices=True)[2].T
    z = x @ axes
    scale = np.sqrt((z**2).mean()) or 1.0
    turn = np.linalg.qr(np.random.default_rng(11).normal(size=(len(axes), len(axes))))[0]
    for _ in range(ITERATIONS):
        signs = np.where(z @ turn > 0, scale, -scale)
        u, _, vt = np.linalg.svd(z.T @ signs)
        turn = u @ vt
    index = Index(centre, axes @ turn, 0)
    queries = sample[:256]
    d = np.stack([_distances(q[None], sample)[0] for q in queries])
    d[np.arange(len(queries)), np.arange(len(queries))] = np.inf
    codes = index.codes(sample)
    near = np.argsort(d, axis=1, kind="stable")[:, : min(k, len(sample) - 1)]
    bits = _differing_bits(codes[: len(queries), None, :], codes[near])
    radius = int(np.quantile(bits, recall, method="higher")) if bits.size else 8 * codes.shape[1]
    return index._replace(radius=radius)


class Substrings:
    """An index of codes by one substring each: rows sorted by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.orders = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        counts = [np.bincount(codes[:, j], minlength=256) for j in range(codes.shape[1])]
        self.starts = [np.concatenate([[0], np.cumsum(c)]) for c in counts]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code differs in at most `radius` bits, by probing and then counting."""
        found = np.zeros(len(self.codes), dtype=bool)
        for j, (order, starts) in enumerate(zip(self.orders, self.starts)):
            for value in _ball(radius // len(self.orders)) ^ int(code[j]):
                found[order[starts[value] : starts[value + 1]]] = True
        rows = np.flatnonzero(found)
        return rows[_differing_bits(self.codes[rows], code) <= radius]


_BALLS: dict[int, np.ndarray] = {}


def _ball(radius: int) -> np.ndarray:
    """All values of a substring with at most `radius` bits set."""
    if radius not in _BALLS:
        sets = itertools.chain.from_iterable(
            itertools.combinations(range(SUBSTRING_BITS), n)
            for n in range(min(radius, SUBSTRING_BITS) + 1)
        )
        _BALLS[radius] = np.array([sum(1 << b for b in s) for s in sets], dtype=np.int64)
    return _BALLS[radius]


def _nearest(ids: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest distances, of equal ones the smaller id, each id once."""
    order = np.lexsort((ids, d))
    first = np.sort(np.unique(ids[order], return_index=True)[1])
    return order[first[:k]]


def _search(
    table: DataFrame, index: Index, ids: np.ndarray, queries: np.ndarray, k: int, radius: int
) -> tuple[DataFrame, Broadcast]:
    """(query_id, id, d): at most k per query and chunk of the table, found where it lies.

    With it comes what was sent to the tasks, to be taken back when they are done.
    """
    sent = table.sparkSession.sparkContext.broadcast((tuple(index), ids, queries, index.codes(queries)))
    width = queries.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt, query_ids, queries, query_codes = sent.value
        index = Index(*learnt)
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(begin, CHUNK_ROWS)
                own = part.column(0).to_numpy()
                rows = part.column(1).flatten().to_numpy().reshape(-1, width)
                parts = Substrings(index.codes(rows))
                hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for query_id, query, code in zip(query_ids, queries, query_codes):
                    near = parts.within(code, radius)
                    near = near[own[near] != query_id]
                    d = np.sqrt(((rows[near] - query) ** 2).sum(axis=1))
                    best = _nearest(own[near], d, k)
                    hits.append((np.full(len(best), query_id), own[near][best], d[best]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*hits)], ["query_id", "id", "d"]
                )

    return table.mapInArrow(run, "query_id long, id long, d double"), sent


def _top(hits: DataFrame, k: int) -> DataFrame:
    single = hits.groupBy("query_id", "id").agg(F.min("d").alias("d"))
    by = Window.partitionBy("query_id").orderBy("d", "id")
    return single.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
    vector_col: str = "embedding", sample_rows: int = SAMPLE_ROWS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, id, score): the k rows of `table` nearest to each row of `queries`.

    Nearest is the smallest Euclidean distance, the score; ties go to the smaller id.
    A query's own id is no candidate. Vectors that are null, zero or hold a null or
    non-finite component take no part, nor do rows without id or, against the length
    that most of the sample has, of another length. Of rows with one id each id is
    returned once, at its smallest distance; of queries with one id one is taken.

    The radius is learnt, so a few neighbours may be missed; a query that finds fewer
    than k is searched again without radius, which is exact. Queries are taken in blocks
    of a fixed size, each against all rows where they lie; a block's result is written
    before the next one starts, so the driver holds one block at a time.
    """
    spark = table.sparkSession
    rows = vectors_of(table, id_col, vector_col)
    asked = vectors_of(queries, id_col, vector_col)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow()
    schema = f"query_id long, rank int, `{id_col}` long, score double"
    lists = [np.array(v) for v in sample.column("v").to_pylist()]
    if not lists:
        return spark.createDataFrame([], schema)
    width = int(np.bincount([len(v) for v in lists]).argmax())
    index = learn(np.stack([v for v in lists if len(v) == width]), k)
    rows, asked = (x.filter(F.size("v") == width) for x in (rows, asked))
    counted = asked.count()
    blocks = max(1, -(-counted // query_block))
    path = shared_dir(spark, "neighbours")
    candidates = None
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id", "v").toArrow()
        if not block.num_rows:
            continue
        ids, first = np.unique(block.column("id").to_numpy(), return_index=True)
        matrix = np.array(block.column("v").to_pylist())[first]
        found, sent = _search(rows, index, ids, matrix, k, index.radius)
        _top(found, k).write.parquet(f"{path}/near/block={b}")
        sent.unpersist()
        got = spark.read.parquet(f"{path}/near/block={b}").groupBy("query_id").count().toArrow()
        full = got.filter(pc.greater_equal(got.column("count"), k)).column("query_id").to_numpy()
        short = ~np.isin(ids, full)
        if short.any():
            every, sent = _search(rows, index, ids[short], matrix[short], k, 8 * matrix.shape[1])
            _top(every, k).write.parquet(f"{path}/far/block={b}")
            sent.unpersist()
            candidates = f"{path}/far"
    if not counted:
        return spark.createDataFrame([], schema)
    result = spark.read.parquet(f"{path}/near")
    if candidates:
        again = spark.read.parquet(candidates)
        result = result.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)
    return result.select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col),
        F.col("d").alias("score"),
    )
