"""Repair of conversations' structure by an auction for shortest paths.

A conversation is a lattice: a node is a place between turns and what roles stand before
it, an arc keeps, re-roles or deletes the next turn, or inserts one. The cheapest way from
its beginning to its end repairs it. The way is found by auction: every node has a price, a
path grows from the origin to the neighbour that is cheapest with its price, and where its
last node is priced below that, the node's price is raised and the path gives it up. Once
the path arrives, every shortest path runs along arcs whose price difference is just their
cost; the one whose letters come first is traced along them.

Long conversations are cut into blocks of turns. A block is repaired from each role to each
role by itself, in parallel and once per pattern of roles and faults, and blocks are then
chained over four roles each. Only a conversation's digest needs its turns one after
another: they pass through one task in order, and are not held there.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.session import materialize

BLOCK = 32  # turns that one auction is about
CACHED_PATTERNS = 20_000
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs of edits, and of a truncated turn that stays
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# What roles stand before a place: none, a system's, up to a user's, up to an assistant's.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
# Where a role of that initial leads; others lead nowhere.
NEXT = {
    BEGIN: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER},
}
CLOSED = (BEGIN, ASSISTANT)  # a repaired conversation ends there
NAMES = {"u": "user", "a": "assistant"}
# Faults, and a turn without any.
FINE, BLANK, DUPLICATE, TRUNCATED_TURN = ".", "b", "d", "t"


def _arcs(pattern: str, closing: bool) -> dict[tuple[int, int], list[tuple[str, int, tuple[int, int]]]]:
    """(letter, cost, next node) of every node of the lattice.

    `pattern` holds a role's initial and a fault for each turn. Turns are inserted before a
    turn, and behind the last one if the pattern is `closing`.
    """
    turns = [pattern[i : i + 2] for i in range(0, len(pattern), 2)]
    arcs = {}
    for i in range(len(turns) + 1):
        for state in range(4):
            out = arcs[i, state] = []
            (new,) = (s for r, s in NEXT[state].items() if r in NAMES)
            if i < len(turns):
                role, fault = turns[i]
                out.append(("D", DELETE, (i + 1, state)))
                if fault in (FINE, TRUNCATED_TURN):
                    more = TRUNCATED if fault == TRUNCATED_TURN else 0
                    if role in NEXT[state]:
                        out.append(("K", KEEP + more, (i + 1, NEXT[state][role])))
                    out.append(("R", REROLE + more, (i + 1, new)))
            if i < len(turns) or closing:
                out.append(("I", INSERT, (i, new)))
    return arcs


def _reaching(arcs: dict, goal: tuple[int, int]) -> set:
    """The nodes from which arcs lead to the goal."""
    back: dict = {}
    for node, out in arcs.items():
        for _, _, to in out:
            back.setdefault(to, []).append(node)
    found, todo = {goal}, [goal]
    while todo:
        for node in back.get(todo.pop(), ()):
            if node not in found:
                found.add(node)
                todo.append(node)
    return found


def auction(arcs: dict, origins: list, goal: tuple[int, int]) -> dict:
    """(cost, letters) of the cheapest way from each origin to the goal, ties to the first letters in ASCII order.

    Origins without a way are left out. Prices are kept from one origin to the next: they
    only rise, and never above what the rest of the way costs. All cycles cost something.
    """
    open_nodes = _reaching(arcs, goal)
    ways = {
        node: [(cost, to) for _, cost, to in out if to in open_nodes]
        for node, out in arcs.items() if node in open_nodes
    }
    price = dict.fromkeys(open_nodes, 0)
    starts = [o for o in origins if o in open_nodes]
    for origin in starts:
        path = [origin]
        while path[-1] != goal:
            node = path[-1]
            least, best = min((cost + price[to], to) for cost, to in ways[node])
            if price[node] < least:  # contract
                price[node] = least
                if len(path) > 1:
                    path.pop()
            else:  # extend
                path.append(best)
    tight = {
        node: [x for x in arcs[node] if x[2] in open_nodes and price[node] == x[1] + price[x[2]]] for node in ways
    }
    leading = _reaching(tight, goal)
    found = {}
    for origin in starts:
        node, letters = origin, []
        while node != goal:
            letter, _, node = min(x for x in tight[node] if x[2] in leading)
            letters.append(letter)
        found[origin] = price[origin], "".join(letters)
    return found


@functools.lru_cache(CACHED_PATTERNS)
def repairs(pattern: str, closing: bool = False) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """For each role before a block and each role after it, the cheapest (cost, letters), or none."""
    arcs, n = _arcs(pattern, closing), len(pattern) // 2
    to = [auction(arcs, [(0, s) for s in range(4)], (n, goal)) for goal in range(4)]
    return tuple(tuple(to[goal].get((0, s)) for goal in range(4)) for s in range(4))


def chained(patterns: Iterator[str]) -> tuple[int, list[str]]:
    """The least cost of a conversation and the letters of its blocks, whose patterns come last block first;
    the letters behind the last turn are one more element."""
    closing = repairs("", True)
    # From each role on: what the rest costs, and per block, last first, where to and by which letters.
    rest, steps = [], []
    ends = []
    for s in range(4):
        cost, letters = min(x for x in (closing[s][e] for e in CLOSED) if x is not None)
        rest.append(cost)
        ends.append(letters)
    for pattern in patterns:
        choice, costs = [], []
        for ways in repairs(pattern):
            # No block's letters begin with another's, so the first letters decide ties.
            cost, letters, goal = min((w[0] + rest[g], w[1], g) for g, w in enumerate(ways) if w is not None)
            choice.append((goal, letters))
            costs.append(cost)
        rest = costs
        steps.append(choice)
    state, out = BEGIN, []
    for choice in reversed(steps):
        state, letters = choice[state]
        out.append(letters)
    return rest[BEGIN], [*out, ends[state]]


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone) of turns (conv_id, turn, role, text), damaged by a checksum of their place.

    Of twenty turns one goes, one loses its text, one its full stops, one is there twice,
    and one becomes the user's. Null roles and texts are one space.
    """
    blank = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(place.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return turns.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _ordered(turns: DataFrame) -> DataFrame:
    """(conv_id, part, block, place, turn, role, text, mark) of turns in order: by turn, role and text, nulls first.

    `mark` is the role's initial and the fault, empty for turns that are gone. Parts are ranges of
    the order, so a long conversation is spread over tasks; blocks are numbered within a part.
    """
    # Texts of a role that stand in several turns of a conversation: the first turn's is no repeat.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    key = ["conv_id", "role", "digest"]
    keyed = turns.withColumn("digest", F.when(~F.col("gone"), _digest(F.col("text")))).withColumn("place", turn)
    again = (
        keyed.filter("NOT gone").groupBy(*key).agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .filter("first < last").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    words = F.btrim("text", F.lit(SPACES))
    fault = (
        F.when(words == "", BLANK).when(F.col("first") < F.col("place"), DUPLICATE)
        .when(~F.substring(words, -1, 1).isin(*ENDS), TRUNCATED_TURN).otherwise(FINE)
    )
    initial = F.rpad(F.substring("role", 1, 1), 1, " ")
    marked = keyed.join(again, same, "left").select(
        "conv_id", "turn", "role", "text", F.when(F.col("gone"), "").otherwise(F.concat(initial, fault)).alias("mark")
    )
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role"]
    ranged = (
        marked.repartitionByRange(*order, F.substring("text", 1, 64))
        .sortWithinPartitions(*order, "text").withColumn("part", F.spark_partition_id())
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen, block, length, place = None, None, 0, 0, 0
        for batch in batches:
            blocks, marks, places = [], [], []
            for row in zip(*(batch.column(c).to_pylist() for c in range(5))):
                mark = row[4]
                if place and row[0] != conv:
                    block, length = block + 1, 0
                conv = row[0]
                if mark:
                    # Copies of a row follow each other, within one part.
                    if row[:4] == seen and mark[1] != BLANK:
                        mark = mark[0] + DUPLICATE
                    seen = row[:4]
                    if length == BLOCK:
                        block, length = block + 1, 0
                    length += 1
                blocks.append(block)
                marks.append(mark)
                places.append(place)
                place += 1
            if blocks:
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in range(4)), pa.array(marks), batch.column(5), pa.array(blocks, pa.int64()),
                     pa.array(places, pa.int64())],
                    ["conv_id", "turn", "role", "text", "mark", "part", "block", "place"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    return ranged.mapInArrow(
        number,
        f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string, mark string, part int, block long, place long",
    )


def _repaired_blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, part, block, letters, cost): the edits of each block, and of what stands behind the
    last turn in one block more; the conversation's cost is in its every block."""
    patterns = rows.filter("mark != ''").groupBy("conv_id", "part", "block").agg(
        # As many turns as a block has at most.
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "mark"))), lambda x: x["mark"]), "").alias("pattern")
    )
    kind = rows.schema["conv_id"].dataType.simpleString()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, blocks = None, []

        def done() -> pa.RecordBatch:
            cost, letters = chained(p for _, _, p in blocks)
            last = blocks[0]
            places = [*((p, b) for p, b, _ in reversed(blocks)), (last[0], last[1] + 1)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([conv] * len(places), kinds), pa.array([p for p, _ in places], pa.int32()),
                    pa.array([b for _, b in places], pa.int64()), pa.array(letters, pa.string()),
                    pa.array([cost] * len(places), pa.int64()),
                ],
                ["conv_id", "part", "block", "letters", "cost"],
            )

        for batch in batches:
            kinds = batch.schema.field(0).type
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if blocks and row[0] != conv:
                    out.append(done())
                    blocks = []
                conv = row[0]
                blocks.append(row[1:])
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
        if blocks:
            yield done()

    dealt = patterns.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("block"))
    return dealt.mapInArrow(chain, f"conv_id {kind}, part int, block long, letters string, cost long")


def _in_order(rows: DataFrame) -> DataFrame:
    """Turns with what their block is to become: a row without a place tells it before the block's turns."""
    blocks = _repaired_blocks(rows).select(
        "conv_id", "part", "block", F.lit(-1).cast("long").alias("place"), "cost", "letters",
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "mark")],
    )
    both = rows.withColumns({"cost": F.lit(None).cast("long"), "letters": F.lit(None).cast("string")})
    both = both.select(blocks.columns).unionByName(blocks)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "place")


class _Turns:
    """Follows a conversation: which turns its letters make of it."""

    def __init__(self):
        self.state, self.letters = BEGIN, iter(())

    def _insert(self) -> tuple[str, str]:
        (role,) = (r for r in NEXT[self.state] if r in NAMES)
        self.state = NEXT[self.state][role]
        return NAMES[role], ""

    def behind(self, letters: str) -> list[tuple[str, str, str]]:
        """Turns inserted behind all others, if that is all the letters say; else they are for the turns to come."""
        if letters.strip("I"):
            self.letters = iter(letters)
            return []
        return [("I", *self._insert()) for _ in letters]

    def turn(self, role: str, text: str) -> list[tuple[str, str, str]]:
        """(letter, role, text) that a turn becomes, those before it first; deleted ones have no role."""
        out = []
        for letter in self.letters:
            if letter == "I":
                out.append((letter, *self._insert()))
                continue
            if letter == "R":
                out.append((letter, *self._insert()[:1], text))
            elif letter == "K":
                self.state = NEXT[self.state][role[:1]]
                out.append((letter, role, text))
            else:
                out.append((letter, None, None))
            return out
        raise ValueError("a turn has no letter")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of the turns (conv_id, turn, role, text) after repair.

    Edits are the letters K, R and I; deleted turns are left out. `place` counts from 0. A long
    conversation passes through one task in order, without being held there. Nulls, ties and repeated
    rows count as in `repair_report`.
    """
    rows = materialize(_ordered(_plain(turns)), "turns")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, place = None, _Turns(), None
        for batch in batches:
            out = []
            for c, n, letters, role, text, mark in zip(*(x.to_pylist() for x in batch.columns)):
                if place is None or c != conv:
                    conv, state, place = c, _Turns(), 0
                edits = state.behind(letters) if n < 0 else state.turn(role, text) if mark else []
                for letter, role, text in edits:
                    if letter != "D":
                        out.append((c, place, letter, role, text))
                        place += 1
            if out:
                kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*out), kinds)], ["conv_id", "place", "edit", "role", "text"]
                )

    return _in_order(rows).select("conv_id", "place", "letters", "role", "text", "mark").mapInArrow(
        run, f"conv_id {kind}, place long, edit string, role string, text string"
    )


def _plain(turns: DataFrame) -> DataFrame:
    """The turns' own columns, with null roles and texts as one space; `gone` ones only name their conversation."""
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    return turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce(gone, F.lit(False)).alias("gone"),
    )


def repair_report(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    A conversation's turns are taken in order of turn, role and text, nulls first; a null role or text
    is one space, and a null conv_id is a conversation like any other. `gaps` counts turn numbers
    that are missing between the least and the greatest; each turn's first fault counts: blank, duplicate
    (role and text stood before), truncated (ends in no full stop); `illegal` counts neighbours
    whose roles may not follow each other. A role counts by its initial, an empty one as unknown. `audit`
    holds the letters of the cheapest repair: Keep, Rerole, Delete, Insert; ties go to the first in ASCII
    order. The digest is of the repaired `role:text`, joined by line feeds. Turns whose column `gone`
    is set only name their conversation; without others it has zeros, an empty audit and the digest
    of nothing. Equal rows repeated are duplicates. Texts of any length are whole, other columns are ignored, an
    empty table gives no rows.

    A task keeps of a conversation the letters of its edits, not its turns.
    """
    rows = materialize(_ordered(_plain(turns)), "turns")
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Report | None = None
        for batch in batches:
            out = []
            for c, n, cost, letters, turn, role, text, mark in zip(*(x.to_pylist() for x in batch.columns)):
                if now is None or c != now.conv:
                    if now is not None:
                        out.append(now.row())
                    now = _Report(c)
                if n < 0:
                    now.block(cost, letters)
                elif mark:
                    now.turn(turn, role, text, mark)
            if out:
                yield batch_of(out, batch.schema.field(0).type)
            kinds = batch.schema.field(0).type
        if now is not None:
            yield batch_of([now.row()], kinds)

    def batch_of(out: list[tuple], kinds: pa.DataType) -> pa.RecordBatch:
        types = [kinds, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), types)], _Report.COLUMNS)

    return _in_order(rows).select("conv_id", "place", "cost", "letters", "turn", "role", "text", "mark").mapInArrow(
        run,
        f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, repaired_sha256 string",
    )


class _Report:
    """What a conversation's turns add up to, one after another."""

    COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def __init__(self, conv):
        self.conv, self.cost, self.turns = conv, 0, _Turns()
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED_TURN, FINE), 0)
        self.low = self.high = self.role = None
        self.distinct = self.illegal = 0
        self.audit: list[str] = []
        self.sha, self.begun = hashlib.sha256(), False

    def _write(self, edits: list[tuple[str, str, str]]) -> None:
        for _, role, text in edits:
            if role is not None:
                self.sha.update((("\n" if self.begun else "") + f"{role}:{text}").encode())
                self.begun = True

    def block(self, cost: int, letters: str) -> None:
        self.cost = cost
        self.audit.append(letters)
        self._write(self.turns.behind(letters))

    def turn(self, turn, role: str, text: str, mark: str) -> None:
        self.faults[mark[1]] += 1
        if self.role is not None and self.role + mark[0] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = mark[0]
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.distinct = turn, self.distinct + 1
        self._write(self.turns.turn(role, text))

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return (
            self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED_TURN], self.illegal,
            self.cost, "".join(self.audit), self.sha.hexdigest(),
        )
