"""Byte-level BPE encoding and decoding on padded numpy matrices.

Texts are cut into pieces by the tokenizer's pattern. Pieces that a task has not met
yet are sorted into matrices by length, a row each. In every round each row merges
its leftmost pair of lowest rank; pairs are looked up in a hash table of arrays, rows
without a pair to merge leave the matrix, and it shrinks to its longest row.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.iinfo(np.int32).max  # rank of a pair that is no token
MAX_ROW = 512  # bytes; longer pieces merge by a heap, as a round moves a whole row
MATRIX_CELLS = 1 << 20
CACHED_PIECES = 300_000
SLICE_CHARS = 1 << 21  # of texts encoded together


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 text and a number."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


class PairTable:
    """Hash table from a pair of token ids to the id of their union."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[t[:i]] << 32 | ranks[t[i:]], r)
            for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        ]
        keys = np.array([p[0] for p in pairs], dtype=np.uint64)
        values = np.array([p[1] for p in pairs], dtype=np.int32)
        self.bits = max(4, int(2 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.values = np.full(size, NONE, dtype=np.int32)
        slots, waiting = self._slots(keys), np.arange(len(keys))
        while len(waiting):
            at = slots[waiting]
            free = self.keys[at] == np.iinfo(np.uint64).max
            self.keys[at[free]] = keys[waiting[free]]  # of several for a slot the last stays
            placed = self.keys[at] == keys[waiting]
            self.values[at[placed]] = values[waiting[placed]]
            waiting = waiting[~placed]
            slots[waiting] = (slots[waiting] + 1) & (size - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = (keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's union, NONE where there is none; negative ids are padding."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).view(np.uint64)
        out = np.full(keys.shape, NONE, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[todo]
        slots = self._slots(keys)
        flat = out.ravel()
        while len(todo):
            found = self.keys[slots]
            hit = found == keys
            flat[todo[hit]] = self.values[slots[hit]]
            go_on = ~hit & (found != np.iinfo(np.uint64).max)
            todo, keys = todo[go_on], keys[go_on]
            slots = (slots[go_on] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(out.shape)


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.pairs = PairTable(ranks)
        self.ranks = ranks
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The token ids of every piece; each piece is encoded by itself."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        for i in np.flatnonzero(lengths > MAX_ROW):
            out[i] = self._by_heap(pieces[i])
        order = np.argsort(lengths, kind="stable")
        order = order[(lengths[order] <= MAX_ROW) & (lengths[order] > 0)]
        at = 0
        while at < len(order):
            # A bucket holds lengths up to a quarter over its shortest one.
            longest = max(lengths[order[at]] * 5 // 4, lengths[order[at]] + 1)
            end = min(np.searchsorted(lengths[order], longest, "right"), at + MATRIX_CELLS // longest)
            bucket = order[at:end]
            for i, ids in zip(bucket, self._matrix([pieces[j] for j in bucket])):
                out[i] = ids
            at = end
        return out

    def _matrix(self, pieces: list[bytes]) -> Iterator[np.ndarray]:
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        columns = np.arange(lengths.max())
        ids = np.full((len(pieces), len(columns)), -1, dtype=np.int32)
        ids[columns < lengths[:, None]] = self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = np.full(ids.shape, NONE, dtype=np.int32)
        ranks[:, :-1] = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        done: list[np.ndarray | None] = [None] * len(pieces)
        rows = np.arange(len(pieces))
        while len(rows):
            best = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), best]
            ended = low == NONE
            if ended.any():
                for k in np.flatnonzero(ended):
                    done[rows[k]] = ids[k, : lengths[k]].copy()
                stay = ~ended
                rows, lengths, best, low = rows[stay], lengths[stay], best[stay], low[stay]
                if not len(rows):
                    break
                width = lengths.max()
                ids, ranks, columns = ids[stay, :width], ranks[stay, :width], columns[:width]
            # Each row loses the place behind its merged pair, so the rest is a matrix again.
            keep = columns != best[:, None] + 1
            every, columns = np.arange(len(rows)), columns[:-1]
            ids = ids[keep].reshape(len(rows), -1)
            ranks = ranks[keep].reshape(len(rows), -1)
            lengths = lengths - 1
            ids[every, best] = low
            inner = np.flatnonzero(best > 0)
            outer = np.flatnonzero(best + 1 < lengths)
            ranks[every, best] = NONE
            row = np.concatenate([inner, outer])
            at = np.concatenate([best[inner] - 1, best[outer]])
            ranks[row, at] = self.pairs.rank(ids[row, at], ids[row, at + 1])
        return iter(done)

    def _by_heap(self, piece: bytes) -> np.ndarray:
        """The same merges for a long piece: lowest rank first, of equal ones the leftmost."""
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [
            (r, i, 2) for i in range(len(parts) - 1)
            if (r := self.ranks.get(piece[i : i + 2])) is not None
        ]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < len(parts) and (r := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[j])))

        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two was merged meanwhile
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([self.ranks[p] for p in parts if p is not None], dtype=np.int32)


class TextEncoder:
    """Encodes texts; remembers the pieces met lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = Encoder(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as bytes of 32-bit integers."""
        found = [self.pattern.findall(t) for t in texts]
        met = set().union(*found)
        if len(self.pieces) + len(met) > CACHED_PIECES:
            self.pieces = {p: self.pieces[p] for p in met & self.pieces.keys()}
        new = [p for p in met if p not in self.pieces]
        ids = self.encoder.encode([p.encode("utf-8") for p in new])
        self.pieces.update(zip(new, (i.tobytes() for i in ids)))
        return [b"".join(map(self.pieces.__getitem__, f)) for f in found]


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Borders of neighbouring texts of about that many characters together."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def encode_documents(
    docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids array<int>) of every row: each match of the pattern is encoded by itself.

    `ranks` is the content of a rank file, `pattern` must match all of any text. A
    null or empty text has no ids. Repeated rows give a row each; other columns are
    dropped. Nothing is shuffled.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(read_ranks(ranks), pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(texts):
                encoded = encoder.encode(texts[begin:end])
                offsets = np.concatenate([[0], np.cumsum([len(e) // 4 for e in encoded])])
                values = pa.array(np.frombuffer(b"".join(encoded), dtype=np.int32))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column(0)[begin:end], ids], [id_col, "ids"])

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        run, f"`{id_col}` {id_type}, ids array<int>"
    )


def decode_documents(encoded: DataFrame, ranks: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, bytes) of every row; null ids decode to no bytes. An unknown id is an error."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {r: t for t, r in read_ranks(ranks).items()}
        for batch in batches:
            ids = batch.column(1)
            lists = (None if x.values is None else x.values.to_numpy() for x in ids)
            data = [b"" if x is None else b"".join(map(tokens.__getitem__, x.tolist())) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, pa.array(data, pa.binary())], [id_col, "ids", "bytes"]
            )

    return encoded.select(F.col(f"`{id_col}`"), F.col(f"`{ids_col}`").alias("ids")).mapInArrow(
        run, f"`{id_col}` {id_type}, ids array<int>, bytes binary"
    )
