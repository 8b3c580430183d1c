"""Fingerprints of documents as invertible Bloom lookup sketches of their paragraphs.

A document is the set of its paragraphs' digests; a repeated paragraph counts as often as
it stands there, each time under a digest of its own. Each digest is added to three cells
of a sketch. The difference of two sketches is the sketch of what only one document has:
cells that hold one digest are peeled until none is left, which gives back the differing
digests themselves. Where peeling gets stuck, for too many of them, both documents are
sketched again with more cells.

A line is cut at words that their digest chooses, about every third, so that an edit
changes the paragraphs it touches and no others, however long the lines are.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import SLICE_BYTES
from feedlake.session import materialize

CELLS = 24  # of a stored fingerprint; three parts of eight
PARTS = 3  # cells of a digest, one in each part
GROWTH = 4  # of the cells where peeling gets stuck
CUT_EVERY = 3  # words of a paragraph on average, within a line
ROWS_PER_RANGE = 1024  # documents that lie next to each other in one task
MAX_RANGES = 100_000

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_CELL = np.dtype([("count", "<i4"), ("check", "<u4"), ("total", "<u8")])


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits well mixed."""
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def paragraphs(texts: list[str]) -> list[np.ndarray]:
    """Each text's paragraphs as sorted 64-bit digests, without repeats.

    Words stand between ASCII white space. A paragraph ends with its line or after a word
    that its digest chooses, and is told by its words in order. One that stands there n times
    gives n digests. A text without words gives none.
    """
    data = [t.encode("utf-8") for t in texts]
    raw = np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8)
    text_ends = np.cumsum([len(d) + 1 for d in data])
    blank = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    # A word's digest is a difference of running sums, shifted back to its first place.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[raw] * _powers(_STEP, len(raw)))])
    word = mixed((sums[ends] - sums[starts]) * _powers(_BACK, len(raw))[starts] + (ends - starts).astype(np.uint64))
    if not len(word):
        return [np.zeros(0, np.uint64) for _ in texts]
    line = np.searchsorted(np.flatnonzero(raw == 10), starts)
    closes = np.append(line[1:] != line[:-1], True) | (word % _U(CUT_EVERY) == 0)
    last = np.flatnonzero(closes)
    first = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(word)) - np.repeat(first, last - first + 1)
    part = mixed(np.add.reduceat(word * mixed(place.astype(np.uint64) + _U(1)), first) + (last - first + 1).astype(np.uint64))
    owner = np.searchsorted(text_ends, starts[first], "right")
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    return [_numbered(np.sort(p)) for p in np.split(part, cuts)]


def _numbered(part: np.ndarray) -> np.ndarray:
    """Sorted digests, of which equal ones are told apart by their number."""
    again = part[1:] == part[:-1]
    if not again.any():
        return part
    begin = np.flatnonzero(np.append(True, ~again))
    number = np.arange(len(part)) - np.repeat(begin, np.diff(np.append(begin, len(part))))
    return np.sort(np.where(number > 0, mixed(part + mixed(number.astype(np.uint64))), part))


class Cells(NamedTuple):
    """A row of cells for every set: how many digests each holds, their sum, and that of their checks."""

    count: np.ndarray
    total: np.ndarray
    check: np.ndarray

    def rows(self, which: np.ndarray) -> Cells:
        return Cells(*(x[which] for x in self))


def sketch(sets: list[np.ndarray], cells: int = CELLS) -> Cells:
    n = len(sets)
    out = Cells(np.zeros(n * cells, np.int32), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint32))
    keys = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    if len(keys):
        row = np.repeat(np.arange(n), [len(s) for s in sets])
        checks = _checks(keys)
        for place in _places(keys, cells):
            flat = row * cells + place
            out.count[:] += np.bincount(flat, minlength=n * cells).astype(np.int32)
            np.add.at(out.total, flat, keys)
            np.add.at(out.check, flat, checks)
    return Cells(*(x.reshape(n, cells) for x in out))


def _places(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cells of each key, one in each part; another choice for every size."""
    part = cells // PARTS
    return [
        (mixed(keys ^ mixed(np.array([cells * PARTS + i], np.uint64))) % _U(part)).astype(np.int64) + i * part
        for i in range(PARTS)
    ]


def _checks(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys + _U(_STEP)) >> _U(32)).astype(np.uint32)


def subtract(left: Cells, right: Cells) -> Cells:
    """The sketches of what only one side has: digests of the right side count below nothing."""
    return Cells(*(x - y for x, y in zip(left, right)))


def peel(cells: Cells) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Per row the digests of the left side alone and of the right side alone, whether all are found, and
    of those that are not how many there are at least."""
    count, total, check = (x.copy() for x in cells)
    n, width = count.shape
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    active = np.arange(n)
    while len(active):
        r, c = np.nonzero(np.abs(count[active]) == 1)
        r = active[r]
        sign = count[r, c]
        key = np.where(sign < 0, _U(0) - total[r, c], total[r, c])
        checks = _checks(key)
        pure = np.where(sign < 0, np.uint32(0) - check[r, c], check[r, c]) == checks
        r, key, sign, checks = r[pure], key[pure], sign[pure], checks[pure]
        # A digest may be alone in several of its cells: it is taken once.
        _, once = np.unique(key ^ mixed(r.astype(np.uint64)), return_index=True)
        r, key, sign, checks = r[once], key[once], sign[once], checks[once]
        signed = np.where(sign < 0, _U(0) - key, key), np.where(sign < 0, np.uint32(0) - checks, checks)
        for place in _places(key, width):
            np.subtract.at(count, (r, place), sign)
            np.subtract.at(total, (r, place), signed[0])
            np.subtract.at(check, (r, place), signed[1])
        found.append((r, key, sign))
        active = np.unique(r)
    done = ~(count.any(1) | total.any(1) | check.any(1))
    row, key, sign = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.argsort(row, kind="stable")
    row, key, sign = row[order], key[order], sign[order]
    cuts = np.searchsorted(row, np.arange(1, n)) if n else []
    both = list(zip(np.split(key, cuts), np.split(sign, cuts))) if n else []
    left = np.bincount(row, minlength=n) + np.abs(count).sum(1) // PARTS
    return [k[s == 1] for k, s in both], [k[s == -1] for k, s in both], done, left


def differences(
    left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS, sketches: tuple[Cells, Cells] | None = None,
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The digests that only one of two sets holds, out of their sketches: pair by pair, each side sorted.

    Pairs whose difference is too large for the cells are sketched again with four times as many,
    or more where what is left asks for them; each size chooses its cells anew.
    """
    only: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] * len(left), [np.zeros(0, np.uint64)] * len(left)]
    sizes = np.full(len(left), cells)
    rest = np.arange(len(left))
    while len(rest):
        now = int(sizes[rest].min())
        group = rest[sizes[rest] == now]
        if sketches is None:
            sketches = sketch([left[i] for i in group], now), sketch([right[i] for i in group], now)
        *sides, done, least = peel(subtract(*sketches))
        for place in np.flatnonzero(done):
            only[0][group[place]], only[1][group[place]] = (np.sort(s[place]) for s in sides)
        stuck = ~done
        sizes[group[stuck]] = now * GROWTH
        while (short := stuck & (sizes[group] < least)).any():
            sizes[group[short]] *= GROWTH
        rest = np.setdiff1d(rest, group[done])
        sketches = None
    return only[0], only[1]


def likeness(n_left: int, n_right: int, n_differing: int) -> float:
    """Shared paragraphs by all paragraphs of two documents; 1 where neither has any."""
    return (n_left + n_right - n_differing) / (n_left + n_right + n_differing) if n_left + n_right else 1.0


def texts_of(cells: Cells) -> list[str]:
    """Sketches as text: equal sets give equal text."""
    out = np.zeros(cells.count.shape, dtype=_CELL)
    for field in ("count", "total", "check"):
        out[field] = getattr(cells, field)
    return [base64.b64encode(row.tobytes()).decode() for row in out]


def edited_with(text: str, other: str) -> str:
    """The text with its last half, rounded down, replaced by as much of the other's beginning, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, guest, id, text): rows in falling order of ids, dealt in ranges, each range followed by
    its next one's first row as a guest, and the last one by the first."""
    spark = docs.sparkSession
    key = F.col(f"`{id_col}`")
    ids = docs.select(key.cast("long").alias("id"))
    n = min(max(ids.count() // ROWS_PER_RANGE, 1), MAX_RANGES)
    dealt = materialize(ids.repartitionByRange(n, F.desc_nulls_last("id")).select("id", F.spark_partition_id().alias("part")), "ranges")
    # One id per range goes to the driver: the first one of it. Rows without id are a range of their own.
    firsts = sorted({r[1] for r in dealt.groupBy("part").agg(F.max("id")).collect() if r[1] is not None}, reverse=True)
    no_id = dealt.filter("id IS NULL").limit(1).count()
    negative = -np.array(firsts, dtype=np.int64)
    ranges = len(firsts) + no_id

    @F.pandas_udf("range int, leads boolean")
    def place_of(ids: pd.Series) -> pd.DataFrame:
        numbers = -ids.fillna(0).to_numpy(np.int64)
        at = np.searchsorted(negative, numbers, "right") - 1
        leads = negative[np.maximum(at, 0)] == numbers if len(negative) else np.zeros(len(ids), bool)
        none = ids.isna().to_numpy()
        return pd.DataFrame({"range": np.where(none, len(negative), at).astype(np.int32), "leads": leads | none})

    rows = docs.select(
        key.cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), place_of(key.cast("long")).alias("at")
    )
    own = F.struct(F.col("at.range").alias("range"), F.lit(False).alias("guest"))
    before = F.struct(F.pmod(F.col("at.range") - 1, F.lit(max(ranges, 1))).cast("int").alias("range"), F.lit(True).alias("guest"))
    places = F.when(F.col("at.leads"), F.array(own, before)).otherwise(F.array(own))
    dealt = rows.select("id", "text", F.explode(places).alias("p")).select("p.range", "p.guest", "id", "text")
    return dealt.repartition("range").sortWithinPartitions("range", "guest", F.desc_nulls_last("id"), "text")


def fingerprint_documents(
    docs: DataFrame, cells: int = CELLS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_chars, fingerprint, edited_text, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the one with the next smaller id, after the last one the first; rows
    with equal ids follow each other in order of their texts, rows without id come last. The
    edited text is `edited_with` the next document's. Likeness is shared paragraphs by all
    paragraphs, out of the differences that the fingerprints give back. Null texts count as
    empty: no paragraphs, and alike only to others without. A single row is its own next one.
    Texts of any length are taken whole, other columns are ignored, and an empty table gives
    no rows. Ids are whole numbers.

    Only ids are read to find the ranges of the order; texts are shuffled once.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def compared(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows of neighbouring documents; the last text only follows the last id."""
        n = len(ids)
        changed = [edited_with(t, other) for t, other in itertools.pairwise(texts)]
        sets = paragraphs(texts + changed)
        own, following, new = sets[:n], sets[1 : n + 1], sets[n + 1 :]
        s_all, s_new = sketch(sets[: n + 1], cells), sketch(new, cells)
        s_own, s_next = s_all.rows(np.arange(n)), s_all.rows(np.arange(1, n + 1))
        near = []
        for other, s_other in ((new, s_new), (following, s_next)):
            sides = differences(own, other, cells, (s_own, s_other))
            near.append([likeness(len(a), len(b), len(x) + len(y)) for a, b, x, y in zip(own, other, *sides)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()),
                pa.array(texts_of(s_own)), pa.array(changed, pa.string()), pa.array(texts_of(s_new)),
                *[pa.array(x, pa.float64()) for x in near],
            ],
            ["id", "n_chars", "fingerprint", "edited_text", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, closed, ids, texts, held = None, False, [], [], 0
        for batch in batches:
            for now, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if now != part:
                    part, closed = now, False
                if closed:
                    continue  # rows that share the guest's id: the first of them follows the range
                if ids and (guest or held > SLICE_BYTES // 4):
                    yield compared(ids, [*texts, text])
                    ids, texts, held = [], [], 0
                if guest:
                    closed = True
                else:
                    ids.append(doc_id)
                    texts.append(text)
                    held += len(text)

    out = _neighbours(docs, id_col, text_col).mapInArrow(
        run,
        "id long, n_chars long, fingerprint string, edited_text string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
    return out.withColumnRenamed("id", id_col).withColumn(id_col, F.col(id_col).cast(id_type))
