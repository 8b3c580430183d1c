"""Near copies by chosen-path set similarity join.

A document is the set of its word shingles, and its sketch holds the least hash of the
set under each of many functions, its minwise tokens. A tree branches a document from
each node into the children of its tokens at those places that a digest of the path
selects, on average one shared child for two documents at the threshold. Documents that
reach the same small node are compared exhaustively, larger nodes branch on. Each tree
finds a similar pair with some probability, which falls with depth, and independent trees
are repeated until a missed pair is very unlikely: all documents go down as many trees as
their first nodes ask for, those in large nodes as many as the deepest node asks for.

Copies of a set are one member, its class. Rounds keep the work linear in large groups:
first every member of a node is compared with one pivot, which links most of a group of
near copies; then only members of different components are compared. A node is compared
inside one task, through which its members pass beside a few of them that are held; pairs
become rows once their sketches agree, and are confirmed on stored sets.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import byte_slices, written
from feedlake.llm.components import components, merged
from feedlake.session import broadcast_if_small, materialize, only_result

PERCENT = 80
TOKENS = 512  # minwise tokens of a sketch, eight bits each
MISS = 1e-5  # chance that no tree finds a pair at the threshold whose sketch lies within the margin
PIVOT_TREES = 6  # the first ones, whose nodes are searched by pivots first
PIVOT_TURNS = 2
BACKGROUND = 0.03  # similarity of unrelated documents that trees must tell apart, chance agreement of tokens included
MAX_LEVELS = 30  # nodes still large then are compared in full
LEVELS_AT_ONCE = 2  # that large nodes branch on by
PAIRS_PER_MEMBER = 512  # a node is small if it holds at most that many pairs to compare for each member
MARGIN = 0.064  # how far a sketch's estimate may lie under the similarity, 3.6 deviations
_ID = "__feedlake_id"
CLUSTER = 4096  # members of a cluster outside its largest component that one task compares with all
PASSING = 4096  # members of a node that pass by its leading ones in one task
MAX_SENT_IDS = 1_000_000  # of documents to compare; more are joined by a shuffle
SLICE = 256  # rows compared or sketched together
SET_BYTES = 1 << 20  # of texts turned into sets together, or one longer text

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits well mixed."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_LETTERS = _mixed(np.arange(1, 257, dtype=np.uint64))
_LETTERS[65:91] = _LETTERS[97:123]  # A-Z as a-z
_STEP = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes.

    Words stand between ASCII white space, A-Z count as small letters. A text of fewer
    words is one shingle; one without words has none.
    """
    data = b" ".join((t or "").encode("utf-8") for t in texts)
    raw = np.frombuffer(data + b" ", dtype=np.uint8)
    ends_at = np.cumsum([len((t or "").encode("utf-8")) + 1 for t in texts])
    blank = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    # A word's hash is a difference of prefix sums, shifted back to its first place.
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[raw] * _powers(_STEP, len(raw)))])
    word = _mixed((sums[ends] - sums[starts]) * _powers(_BACK, len(raw))[starts] + (ends - starts).astype(np.uint64))
    first = np.concatenate([[0], np.searchsorted(starts, ends_at)])
    factors = [_U(pow(_STEP, 3 * j + 1, 1 << 64)) for j in range(words)]
    run = np.zeros(max(len(word) - words + 1, 0), dtype=np.uint64)
    for j, f in enumerate(factors):
        run += word[j : j + len(run)] * f
    run = _mixed(run)
    out = []
    for a, b in itertools.pairwise(first.tolist()):
        if b - a >= words:
            out.append(np.unique(run[a : b - words + 1]))
        elif b > a:
            whole = sum((int(w) * int(f) for w, f in zip(word[a:b], factors)), b - a)
            out.append(_mixed(np.array([whole % (1 << 64)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minwise tokens, 8 bits each, for every set that is not empty."""
    rng = np.random.default_rng(5)
    factors = rng.integers(1 << 31, size=TOKENS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(1 << 32, size=TOKENS, dtype=np.uint32)
    values = np.concatenate(sets).astype(np.uint32)
    begin = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), TOKENS), dtype=np.uint8)
    for i, (a, b) in enumerate(zip(factors, shifts)):
        least = np.minimum.reduceat(values * a + b, begin)
        out[:, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    return out


def _sketched(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n, c1, c2, sketch) of every row with an id; n is the size of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, SET_BYTES):
                sets = shingle_sets(part.column(1).to_pylist(), words)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows: list[bytes | None] = [None] * len(sets)
                if full:
                    for i, row in zip(full, sketches([sets[i] for i in full])):
                        rows[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([int(_mixed(s).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                        pa.array([int(np.bitwise_xor.reduce(_mixed(s ^ _U(_STEP))).view(np.int64)) for s in sets], pa.int64()),
                        pa.array(rows, pa.binary()),
                    ],
                    ["id", "n", "c1", "c2", "sketch"],
                )

    return (
        docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
        .filter("id IS NOT NULL").mapInArrow(run, "id long, n long, c1 long, c2 long, sketch binary")
    )


@functools.cache
def trees_for(levels: int, percent: int) -> int:
    """So many trees miss a pair at the threshold with a chance of at most MISS, if only nodes
    at that depth are compared.

    A place that is selected at a node is a shared child with the chance that the pair's sketches
    agree there; that agreement itself varies from pair to pair, down to the margin.
    """
    share, per_node = percent / 100, _children(percent)
    k = np.arange(TOKENS + 1)
    least = max(share - MARGIN, 0.05)
    if share < 1:
        logs = np.array([math.lgamma(TOKENS + 1) - math.lgamma(i + 1) - math.lgamma(TOKENS - i + 1) for i in k])
        weight = np.exp(logs + k * math.log(share) + (TOKENS - k) * math.log(1 - share))
    else:
        weight = (k == TOKENS).astype(float)
    weight[k < least * TOKENS] = 0
    weight /= weight.sum()
    whole, agree, lost = int(per_node), k / TOKENS, np.zeros(TOKENS + 1)
    for _ in range(levels):
        child = 1 - agree + agree * lost
        lost = child**whole * (1 - (per_node - whole) * (1 - child))
    trees = 1
    while (weight * lost**trees).sum() > MISS:
        trees += 1
    return trees


def _children(percent: int) -> float:
    """How many places are selected at a node on average: one shared child at the threshold."""
    return min(100 / percent, TOKENS)


def _branch(nodes: np.ndarray, tokens: np.ndarray, per_node: float) -> tuple[np.ndarray, np.ndarray]:
    """Children of nodes: which row each comes from, and its key.

    A digest of the node selects the places of the tokens, alike for all documents. Nodes
    differ by one place at most, so fewer of a pair's paths die out than if each token were
    selected by itself.
    """
    digest = _mixed(nodes ^ _U(0xD6E8FEB86659FD93))
    whole = int(per_node)
    n = whole + ((digest >> _U(32)).astype(np.float64) < (per_node - whole) * 2**32)
    row = np.repeat(np.arange(len(nodes)), n)
    turn = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
    first, step = digest[row] & _U(0xFFFF), (digest[row] >> _U(16)) & _U(0xFFFF) | _U(1)
    column = ((first + turn * step) % _U(TOKENS)).astype(np.int64)
    token = tokens[row, column].astype(np.uint64) | (column.astype(np.uint64) << _U(8))
    return row, _mixed(_mixed(token + _U(1)) ^ nodes[row])


def _instances(classes: DataFrame, trees: range, levels: int, percent: int) -> DataFrame:
    """(node, id, n): the nodes that each class reaches at the last of the levels of each tree."""
    per_node = _children(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                tokens = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(-1, TOKENS)
                owners, keys = [], []
                for tree in trees:
                    owner = np.arange(len(tokens))
                    key = np.full(len(tokens), _mixed(np.array([tree + 1], np.uint64))[0])
                    for _ in range(levels):
                        row, key = _branch(key, tokens[owner], per_node)
                        owner = owner[row]
                    owners.append(owner)
                    keys.append(key)
                owner = pa.array(np.concatenate(owners))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), part.column(0).take(owner), part.column(1).take(owner)],
                    ["node", "id", "n"],
                )

    return classes.select("id", "n", "sketch").mapInArrow(run, "node long, id long, n long")


def _shared(instances: DataFrame, label: str) -> DataFrame:
    """The instances in nodes that several classes reach, written; nearly all nodes are reached by one.

    Every later step shuffles these only. Sums are taken of one number per node, so a node of many
    members is one row for each task.
    """

    def shared() -> DataFrame:
        every = materialize(instances, label)
        nodes = every.groupBy("node").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low != high")
        several = materialize(nodes.select("node"), "near_shared")
        return every.join(broadcast_if_small(several, MAX_SENT_IDS), "node", "left_semi")

    return only_result(instances.sparkSession, shared, label)


def _deeper(members: DataFrame, classes: DataFrame, percent: int, levels: int) -> DataFrame:
    """(node, id, n): the nodes that members reach some levels below theirs."""
    per_node = _children(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tokens = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, TOKENS)
                key, row = batch.column(0).to_numpy().view(np.uint64), np.arange(len(tokens))
                for _ in range(levels):
                    child, key = _branch(key, tokens[row], per_node)
                    row = row[child]
                owner = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), batch.column(1).take(owner), batch.column(2).take(owner)],
                    ["node", "id", "n"],
                )

    joined = members.join(classes.select("id", "sketch"), "id")
    return joined.select("node", "id", "n", "sketch").mapInArrow(run, "node long, id long, n long")


def _least_same(percent: int) -> int:
    """So many tokens of two sketches agree at least, if the pair may be similar enough."""
    return math.ceil(max(percent / 100 - MARGIN, 0.05) * TOKENS)


class _Joined(dict):
    """Which labels a task has linked so far."""

    def root(self, x: int) -> int:
        while x in self:
            x = self[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Links two labels; false if they are linked already."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self[max(a, b)] = min(a, b)
        return a != b


def _compared(members: DataFrame, classes: DataFrame, percent: int, kind: str, sets: DataFrame | None = None) -> DataFrame:
    """In each node, its `leading` members against all members of other components.

    `members` has node, id, n, label, leading, and the size of the node. Pairs count whose sizes
    allow the similarity and whose sketches agree as often as the threshold asks. The kind says
    what of them comes out:

    pivots: (a, b, same), each pair;
    near: (a, b, same), labels of pairs, as few as connect them;
    links: (a, b, same), pairs whose `sets` are similar enough, as few as connect their labels:
    most alike first, each pair that might connect more is confirmed.

    A node's leading members come first and are held; all others pass by. They are few where nodes
    are small, since these hold at most so many pairs between components for each member.
    """
    least = _least_same(percent)

    def met(held: list[tuple], rows: list[tuple], itself: bool, joined: _Joined) -> list[tuple[int, int, int]]:
        out: list[tuple[int, int, int]] = []
        if not held or not rows:
            return out
        y = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, TOKENS)
        n_b, label_b = (np.array([r[k] for r in rows], np.int64) for k in (1, 2))
        for i, (id_a, n_a, label_a, sketch, *set_a) in enumerate(held):
            fits = (label_b != label_a) & (100 * np.minimum(n_b, n_a) >= percent * np.maximum(n_b, n_a))
            if itself:
                fits[: i + 1] = False
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            same = (y[at] == np.frombuffer(sketch, np.uint8)).sum(axis=1)
            at, same = at[same >= least], same[same >= least]
            if kind == "pivots":
                out += [(id_a, rows[j][0], s) for j, s in zip(at.tolist(), same.tolist())]
                continue
            for j in at[np.argsort(-same, kind="stable")].tolist():
                label = rows[j][2]
                if kind == "near":
                    if joined.join(label_a, label):
                        out.append((label_a, label, 0))
                elif joined.root(label_a) != joined.root(label) and _similar(set_a[0], rows[j][4], percent):
                    joined.join(label_a, label)
                    out.append((id_a, rows[j][0], 0))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held, rest, joined, out = None, [], [], _Joined(), []

        def closed() -> None:
            nonlocal held, rest, joined
            out.extend(met(held, rest, False, joined))
            if node is not None and not node[1]:
                out.extend(met(held, held, True, joined))
            held, rest, joined = [], [], _Joined()

        for batch in batches:
            for now, place, leading, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (now, place) != node:
                    closed()
                    node = now, place
                if leading:
                    held.append(row)
                elif held:
                    rest.append(row)
                    if len(rest) >= SLICE:
                        out.extend(met(held, rest, False, joined))
                        rest = []
            if out:
                yield _pair_batch(out)
                out.clear()
        closed()
        if out:
            yield _pair_batch(out)

    # A node of many members is dealt over tasks, and its leading members, which are few, go to each.
    parts = F.ceil(F.col("size") / PASSING)
    places = F.when(F.col("leading"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), parts)))
    dealt = members.withColumn("place", F.explode(places.cast("array<long>")))
    columns = ["node", "place", "leading", "id", "n", "label", "sketch"]
    told = dealt.join(classes.select("id", "sketch"), "id")
    if sets is not None:
        told, columns = told.join(sets, "id"), [*columns, "set"]
    told = told.select(*columns).repartition("node", "place")
    told = told.sortWithinPartitions("node", "place", F.desc("leading"), "id")
    return told.mapInArrow(run, "a long, b long, same long")


def _pair_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["a", "b", "same"])


def _similar(x: bytes, y: bytes, percent: int) -> bool:
    """Whether two sets, as sorted hashes, are similar enough."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared)


def _sets(asked: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, set) of the documents asked for; rows that repeat an id and its text are one."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, SET_BYTES):
                sets = shingle_sets(part.column(1).to_pylist(), words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], ["id", "set"])

    ids, n = written(asked.select("id").distinct(), "near_asked", ids=F.count(F.lit(1)))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).join(
        broadcast_if_small(ids, MAX_SENT_IDS), "id", "left_semi"
    )
    sets, found = written(texts.mapInArrow(made, "id long, set binary"), "near_sets", rows=F.count(F.lit(1)))
    # Every id asked for is there, so as many rows as ids mean that none repeats.
    return sets if found["rows"] == n["ids"] else materialize(sets.distinct(), "near_sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): the pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [(a, b) for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)) if _similar(x, y, percent)]
            us, vs = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    return (
        broadcast_if_small(pairs.select("a", "b"), MAX_SENT_IDS)
        .join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
        .select("a", "b", "x", "y").mapInArrow(run, "u long, v long")
    )


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with the component that is known for them so far."""
    known = broadcast_if_small(labels.select(F.col("u").alias("id"), F.col("v").alias("_label")), MAX_SENT_IDS)
    return members.join(known, "id", "left").select(
        "node", "id", "n", F.coalesce("_label", "id").alias("label")
    )


def _mixed_nodes(members: DataFrame) -> DataFrame:
    """(node, mode, size, large): nodes that hold more than one component.

    `mode` is the component with most members there; a node is large if it holds too
    many pairs between components.
    """
    per_label = members.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"))
    nodes = per_label.groupBy("node").agg(
        F.count(F.lit(1)).alias("labels"), F.sum("c").alias("s"),
        F.sum(F.col("c").cast("double") * F.col("c")).alias("squares"),
        F.max_by("label", F.struct("c", "label")).alias("mode"),
    )
    pairs = (F.col("s").cast("double") * F.col("s") - F.col("squares")) / 2
    return nodes.filter("labels > 1").select("node", "mode", F.col("s").alias("size"), (pairs > PAIRS_PER_MEMBER * F.col("s")).alias("large"))


def _to_pivots(members: DataFrame, classes: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): each member with the pivot of another component that its sketch is most like.

    A node's pivot is drawn by a digest, another one each turn, so a member meets as many
    pivots as it has nodes, and the pairs are no more than the members.
    """
    pivots = (
        members.groupBy("node")
        .agg(
            F.min_by("id", F.xxhash64("node", "id", F.lit(turn))).alias("pivot"), F.count(F.lit(1)).alias("size"),
            F.min("label").alias("low"), F.max("label").alias("high"),
        )
        .filter("low != high").select("node", "pivot", "size")
    )
    leading = (F.col("id") == F.col("pivot")).alias("leading")
    pairs = _compared(
        members.join(broadcast_if_small(pivots, MAX_SENT_IDS), "node").select("node", "id", "n", "label", leading, "size"),
        classes, percent, "pivots",
    )
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = pairs.select(F.explode(ways).alias("way"), "same").select("way.a", "way.b", "same")
    best = both.groupBy("a").agg(F.max_by("b", F.struct("same", "b")).alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _across(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes' members for `_compared`: those outside of a node's largest component lead, so that
    members of a large component are never paired with each other."""
    nodes = broadcast_if_small(nodes.select("node", "mode", "size"), MAX_SENT_IDS)
    return members.join(nodes, "node").select(
        "node", "id", "n", "label", (F.col("label") != F.col("mode")).alias("leading"), "size"
    )


def classes_of(members: DataFrame) -> DataFrame:
    """(id, n, c1, c2, sketch, copies): one row per distinct set that is not empty, with its least id."""
    return members.filter("n > 0").groupBy("n", "c1", "c2").agg(
        F.min("id").alias("id"), F.max("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies")
    )


def _links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(u, v): each class that is not the least of its component, with that least one."""
    total = classes.count()
    # So many that hardly any unrelated documents share a node.
    levels = max(2, math.ceil(math.log(max(total, 2)) / -math.log(BACKGROUND)))
    args = (docs, id_col, text_col, words, percent)

    first = _shared(_instances(classes, range(PIVOT_TREES), levels, percent), "near_nodes")
    labels = None
    for turn in range(PIVOT_TURNS):
        members = first.withColumn("label", F.col("id")) if labels is None else _labelled(first, labels)
        pairs = materialize(_to_pivots(members, classes, percent, turn), "near_pairs")
        both = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
        links = _confirmed(pairs, _sets(both, *args[:-1]), percent)
        labels = components(links) if labels is None else merged(labels, links)

    trees = max(trees_for(levels, percent), PIVOT_TREES)
    rest = _shared(_instances(classes, range(PIVOT_TREES, trees), levels, percent), "near_nodes")
    labels, depth, inside = _searched(first.unionByName(rest), classes, labels, levels, args)
    # A pair that these trees did not compare stands in a large node of theirs: its members go down
    # further trees, as many as the deepest nodes ask for.
    while trees_for(depth, percent) > trees:
        begin, trees = trees, trees_for(depth, percent)
        again = _shared(_instances(inside, range(begin, trees), levels, percent), "near_nodes")
        labels, deepest, _ = _searched(again, inside, labels, levels, args)
        depth = max(depth, deepest)
    return labels


def _linked(members: DataFrame, classes: DataFrame, labels: DataFrame, args: tuple) -> DataFrame:
    """Labels after the nodes' members are compared across components.

    Components that are near each other in some node make a cluster. All members of a cluster
    outside its largest component are compared with all others, once, on full sets. Where these are
    too many, they are compared in the nodes instead.
    """
    *given, percent = args
    near, n = written(_compared(members, classes, percent, "near").select("a", "b").distinct(), "near_labels", pairs=F.count(F.lit(1)))
    if not n["pairs"]:
        return labels
    least = components(near.select(F.col("a").alias("u"), F.col("b").alias("v")))
    clusters = least.select(F.col("u").alias("label"), F.col("v").alias("cluster")).unionByName(
        least.select(F.col("v").alias("label"), F.col("v").alias("cluster")).distinct()
    )
    known = classes.select("id", "n", F.lit(0).alias("node"))
    inside = materialize(
        _labelled(known, labels).drop("node").join(broadcast_if_small(clusters, MAX_SENT_IDS), "label"), "near_clusters"
    )
    per_label = inside.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("c"))
    shape = per_label.groupBy("cluster").agg(
        F.sum("c").alias("size"), F.max_by("label", F.struct("c", "label")).alias("mode"), (F.sum("c") - F.max("c")).alias("outside")
    )
    whole = shape.filter(F.col("outside") <= CLUSTER)
    told = inside.join(whole, "cluster").select(
        F.col("cluster").alias("node"), "id", "n", "label", (F.col("label") != F.col("mode")).alias("leading"), "size"
    )
    sets = _sets(inside, *given)
    links = _compared(told, classes, percent, "links", sets)
    if shape.count() > whole.count():
        larger = inside.join(shape.filter(F.col("outside") > CLUSTER).select("cluster"), "cluster", "left_semi").select("id")
        apart = members.join(broadcast_if_small(larger, MAX_SENT_IDS), "id", "left_semi")
        links = links.unionByName(_compared(apart, classes, percent, "links", sets))
    return merged(labels, materialize(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "near_links"))


def _searched(
    members: DataFrame, classes: DataFrame, labels: DataFrame, levels: int, args: tuple
) -> tuple[DataFrame, int, DataFrame | None]:
    """Labels after the nodes of members and all below them are compared, the depth of the last
    ones, and the classes in large nodes of the first level."""
    percent, inside = args[-1], None
    for depth in range(levels, MAX_LEVELS + LEVELS_AT_ONCE, LEVELS_AT_ONCE):
        members = materialize(_labelled(members, labels), "near_members")
        nodes, n = written(
            _mixed_nodes(members), "near_mixed", all=F.count(F.lit(1)), large=F.count(F.when(F.col("large"), 1))
        )
        if not n["all"]:
            break
        last = depth >= MAX_LEVELS or not n["large"]
        if n["all"] > n["large"] or last:
            inside_small = _across(members, nodes if last else nodes.filter("NOT large"))
            labels = _linked(inside_small, classes, labels, args)
        if last:
            break
        large = nodes.filter("large").select("node")
        deeper = members.join(large, "node", "left_semi")
        if inside is None:
            ids = deeper.select("id").distinct()
            inside = materialize(classes.join(broadcast_if_small(ids, MAX_SENT_IDS), "id", "left_semi"), "near_inside")
        members = _shared(_deeper(deeper, classes, percent, LEVELS_AT_ONCE), "near_nodes")
    return labels, depth, inside


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Documents are linked if 100 * shared shingles >= percent * shingles of either;
    components follow links through other documents, and the component's id is its
    smallest document id, whose rows are kept. Candidates are confirmed on full sets.
    A text without words, empty or null, has no shingles and no links; a text of
    fewer words than a shingle is one shingle. Rows with one id count as one document,
    linked as any of them is; rows without an id have no component and are kept. Other
    columns are ignored. Ids are whole numbers. The result is written; nothing else that was
    written for it stays.
    """
    return only_result(docs.sparkSession, lambda: _judged(docs, words, percent, id_col, text_col), "near_found")


def _judged(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    members = materialize(_sketched(docs, id_col, text_col, words), "near_sketches")
    classes = materialize(classes_of(members), "near_classes")
    labels = _links(docs, classes, id_col, text_col, words, percent)
    copied = classes.filter("copies > 1").select("n", "c1", "c2", F.col("id").alias("class"))
    found = (
        members.select("id", "n", "c1", "c2").join(copied, ["n", "c1", "c2"], "left")
        .withColumn("u", F.coalesce("class", "id")).join(labels, "u", "left")
        .select("id", "n", F.coalesce("v", "u").alias("component"))
    )
    without = docs.filter(F.col(f"`{id_col}`").isNull())
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"),
    ).unionByName(
        without.select(
            F.lit(None).cast("long").alias(id_col), F.lit(None).cast("long").alias("n_shingles"),
            F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of documents that `near_duplicates` keeps, with all their columns; of rows with
    one id, one stays. Rows without an id all stay."""
    found = near_duplicates(docs, words, percent, id_col, text_col)
    ids = found.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(_ID)).agg(
        F.min("kept").alias("kept"), F.count(F.lit(1)).alias("copies")
    )
    key = F.col(f"`{id_col}`").cast("long")
    gone = ids.filter("NOT kept OR copies > 1").select(_ID)
    kept = docs.join(gone, key == F.col(_ID), "left_anti")
    repeated = ids.filter("kept AND copies > 1").select(_ID)
    if repeated.limit(1).count():
        again = docs.join(repeated, key == F.col(_ID), "left_semi")
        kept = kept.unionByName(again.dropDuplicates([id_col]))
    return kept
