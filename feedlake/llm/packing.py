"""Packing along a space-filling curve.

Each document's token ids are hashed to a vector, which fixed random signs project
to three dimensions. Documents are sorted by the Hilbert key of that point, so that
neighbours share much of their vocabulary, and laid end to end along the curve; every
4096th token starts a new sequence. Only the last sequence of all is padded.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlake.llm.common import byte_slices
from feedlake.session import materialize

SEQUENCE = 4096
END_ID = 2
FEATURES, DIMENSIONS, BITS = 256, 3, 13
TIE_BITS = 24  # of a digest of the id, below the Hilbert key: equal documents spread too
BUCKET_TOKENS = 1 << 22  # tokens that a task lays out
MAX_BUCKETS = 20_000  # more than that many make buckets larger, not more
RANGES = 16  # of the curve in a bucket; ranges hold equally many documents, buckets tokens
CACHED_WORDS = 150_000  # twice
SHORT = 12

_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """The ids of words between single spaces or line ends, as bytes; learnt when first met.

    Words of Latin letters with ASCII marks behind them, nearly all, go straight to the
    model: their normal form is their small letters, letters and marks are split. Any
    other word is encoded by the whole tokenizer.
    """

    def __init__(self, tokenizer: str, kind: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.encode_special_tokens = True
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.kind = {2: "H", 4: "I"}[np.dtype(kind).itemsize]
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        # Words met since the cache was last full are kept beside the new ones.
        out = self.before.get(word)
        if out is None:
            if word.isascii() and word.isalpha():
                out = self._ids(word.lower())
            else:
                plain = _PLAIN.fullmatch(word)
                if plain:
                    letters, marks = plain.groups()
                    out = self._part(letters) + self._part(marks)
                else:
                    out = array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = out
        return out

    def _ids(self, part: str) -> bytes:
        return array(self.kind, [t.id for t in self.model.tokenize(part)]).tobytes()

    def _part(self, part: str) -> bytes:
        """The ids of letters, which are words themselves, or of marks."""
        out = self.get(part) or self.before.get(part)
        if out is None:
            out = b""
            if part:
                small = part.lower()
                shown = small if part.isascii() else small.encode("utf-8").decode("latin-1").translate(self.letters)
                out = self._ids(shown)
            if len(part) <= SHORT:  # longer ones are seldom met behind other marks
                self[part] = out
        return out

    def trim(self) -> None:
        if len(self) > CACHED_WORDS:
            self.before = dict(self)
            self.clear()


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of integer points along the Hilbert curve of a cube with sides of 2**bits.

    Coordinates are turned into the transposed index from the highest bit down: a set
    bit flips the lower bits of the first coordinate, an unset one swaps them with it.
    """
    x = points.astype(np.int64).T.copy()
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(len(x)):
            flip = (x[i] >> b & 1).astype(bool)
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    parity = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        parity = np.where(x[-1] >> b & 1, parity ^ ((1 << b) - 1), parity)
    x ^= parity
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | (axis >> b & 1)
    return key


def project(ids: list[np.ndarray]) -> np.ndarray:
    """Integer points of documents: hashed counts of ids at unit length, projected by fixed signs."""
    signs = np.random.default_rng(7).choice([-1.0, 1.0], size=(FEATURES, DIMENSIONS))
    counts = np.stack([np.bincount(i % FEATURES, minlength=FEATURES) for i in ids]).astype(float)
    unit = counts / np.maximum(np.linalg.norm(counts, axis=1), 1)[:, None]
    return ((1 + np.tanh(unit @ signs / 2)) / 2 * ((1 << BITS) - 1)).astype(np.int64)


def tokenized(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, key, n, ids): the text's ids and `end_id`, as bytes, and the place along the curve."""
    id_type = docs.schema[id_col].dataType.simpleString()
    size = Tokenizer.from_str(tokenizer).get_vocab_size()
    kind = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    end = np.array([end_id], dtype=kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer, kind)
        for batch in batches:
            for part in byte_slices(batch, 1):
                data = [
                    b"".join(map(words.__getitem__, (t or "").replace("\n", " ").split(" "))) + end
                    for t in part.column(1).to_pylist()
                ]
                words.trim()
                lists = [np.frombuffer(d, dtype=kind) for d in data]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(hilbert_keys(project(lists))),
                        pa.array([len(x) for x in lists], pa.int64()), pa.array(data, pa.binary()),
                    ],
                    [id_col, "key", "n", "ids"],
                )

    words = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        run, f"`{id_col}` {id_type}, key long, n long, ids binary"
    )
    tie = F.shiftrightunsigned(F.xxhash64(f"`{id_col}`"), 64 - TIE_BITS)
    return words.withColumn("key", F.col("key") * (1 << TIE_BITS) + tie)


def pack_documents(
    docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, start, length, doc_tokens, sequence_id, offset, ids) of every piece.

    `tokenizer` is the content of a tokenizer file. Every document is its ids and
    `end_id`, also one with a null or empty text; `ids` holds a piece's ids as
    little-endian 32-bit integers. Pieces fill sequences without gaps, and a document
    longer than the rest of a sequence goes on in the next. Repeated rows are packed
    each. Other columns are dropped; an empty table gives no pieces.

    The tokens are written once. Sums per range of the curve, one number each, tell
    every task where its range starts, so that ranges are laid out independently.
    """
    rows = materialize(tokenized(docs, tokenizer, end_id, id_col, text_col), "packing")
    kind = "<u2" if Tokenizer.from_str(tokenizer).get_vocab_size() <= 1 << 16 else "<u4"
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    total = rows.agg(F.sum("n")).first()[0] or 0
    wanted = max(-(-total // BUCKET_TOKENS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = int(min(wanted, MAX_BUCKETS))
    ranges = buckets * RANGES
    shares = [i / ranges for i in range(1, ranges)]
    borders = np.unique(rows.agg(F.percentile_approx("key", shares, 4 * ranges)).first()[0] or [0])

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, key.to_numpy(), "right").astype(np.int32))

    ranged = rows.withColumn("range", range_of("key"))
    sums = {r[0]: r[1] for r in ranged.groupBy("range").agg(F.sum("n")).collect()}
    # Where each range starts; a task gets neighbouring ranges of about its share of tokens.
    starts, at = np.zeros(len(borders) + 1, dtype=np.int64), 0
    for i in sorted(sums):
        starts[i], at = at, at + sums[i]
    bucket = F.lit((starts * buckets // max(at, 1)).tolist()).cast("array<int>")[F.col("range")]

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place = None, 0
        for batch in batches:
            out: list[tuple] = []
            owner: list[int] = []
            for i, (part, n, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)))):
                if part != now:
                    now, place = part, int(starts[part])
                ids = np.frombuffer(data, dtype=kind).astype("<u4")
                begin = 0
                while begin < n:
                    length = min(n - begin, sequence - place % sequence)
                    out.append((begin, length, n, place // sequence, place % sequence,
                                ids[begin : begin + length].tobytes()))
                    owner.append(i)
                    begin, place = begin + length, place + length
            if not out:
                continue
            columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 5 + [pa.binary()])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), *columns],
                [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    # Ties end in a total order, so a repeated task gives the same.
    ordered = ranged.repartitionById(buckets, bucket).sortWithinPartitions("range", "key", id_col, "ids")
    return ordered.select(id_col, "range", "n", "ids").mapInArrow(
        lay_out,
        f"`{id_col}` {id_type}, start long, length long, doc_tokens long, sequence_id long, "
        "offset long, ids binary",
    )
