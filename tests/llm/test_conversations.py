"""Repair of conversations against a search over all edits, turn by turn."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from feedlake.llm import conversations
from feedlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(marks):
    """(cost, audit, edits) by best-first search over (turns used, roles so far), ties to the least audit."""
    pattern = re.compile("(s?(ua)+)?")
    starts = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, edits = heapq.heappop(heap)
        if i == len(marks) and last in ("", "a"):
            assert pattern.fullmatch("".join(e[1][0] for e in edits if e[1]))
            return cost, audit, edits
        if (i, last) in done:
            continue
        done.add((i, last))
        new = "a" if last == "u" else "u"
        name = {"a": "assistant", "u": "user"}[new]
        heapq.heappush(heap, (cost + 5, audit + "I", i, new, (*edits, ("I", name, ""))))
        if i < len(marks):
            role, text, fault = marks[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, (*edits, ("D", None, None))))
            if fault in ("", "truncated"):
                more = 5 if fault else 0
                if role[:1] in starts[last] and role:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*edits, ("K", role, text))))
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, new, (*edits, ("R", name, text))))
    raise AssertionError


def wanted(rows):
    out = {}
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted(
            [r[1:] for r in after if r[0] == conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
        )
        seen, marks, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated", ""), 0)
        for _, role, text in own:
            words = text.strip(SPACE)
            fault = (
                "blank" if not words else "duplicate" if (role, text) in seen
                else "truncated" if words[-1] not in ".!?" else ""
            )
            seen.add((role, text))
            counts[fault] += 1
            marks.append((role, text, fault))
        turns = [r[0] for r in own if r[0] is not None]
        roles = [(m[0] or " ")[0] for m in marks]
        cost, audit, edits = cheapest(marks)
        text = "\n".join(f"{role}:{text}" for _, role, text in edits if role is not None)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"],
            counts["truncated"], sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def report(frame):
    return {r[0]: tuple(r)[1:] for r in conversations.repair_report(conversations.damaged(frame)).collect()}


def made(seed, n, turns):
    rnd = random.Random(seed)
    words = ["One.", "Two?", "No end", "", " ", "Three!  \n", "four", "Five. six", "Ünï."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in range(n):
        for i in range(rnd.randint(1, turns)):
            turn = rnd.choice([i, i, i, i * 2, None])
            rows.append((conv if conv else None, turn, rnd.choice(roles[: rnd.choice([2, 4, 5, 9])]), rnd.choice([*words, None])))
    return rows


def test_random_conversations(spark):
    rows = made(1, 150, 9)
    rows += rows[:30]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert report(frame) == wanted(rows)


def test_conversations_of_many_blocks(spark):
    """Longer than blocks, and spread over the ranges of the order."""
    rows = made(2, 4, 300)
    assert any(sum(r[0] == c for r in rows) > 4 * conversations.BLOCK for c in {r[0] for r in rows})
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert report(frame) == wanted(rows)


def test_repaired_turns_are_what_the_digest_is_of(spark):
    rows = made(3, 40, 80)
    turns = conversations.damaged(spark.createDataFrame(rows, SCHEMA))
    lines = {}
    for r in sorted(conversations.repaired_turns(turns).collect(), key=lambda r: (str(r[0]), r["place"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, row in report(spark.createDataFrame(rows, SCHEMA)).items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]


@pytest.mark.parametrize("closing", [True, False])
def test_auction_finds_the_cheapest_way_with_the_first_letters(closing):
    rnd = random.Random(5)
    for _ in range(300):
        pattern = "".join(rnd.choice("suax") + rnd.choice("..tbd") for _ in range(rnd.randint(0, 7)))
        for s, row in enumerate(conversations.repairs(pattern, closing)):
            for goal, way in enumerate(row):
                assert way == plain_way(pattern, closing, s, goal)


def plain_way(pattern, closing, start, goal):
    arcs, heap, done = conversations._arcs(pattern, closing), [(0, "", (0, start))], set()
    while heap:
        cost, letters, node = heapq.heappop(heap)
        if node == (len(pattern) // 2, goal):
            return cost, letters
        if node not in done:
            done.add(node)
            for letter, more, to in arcs[node]:
                heapq.heappush(heap, (cost + more, letters + letter, to))
    return None


def test_one_conversation_of_all_rows_and_a_long_text(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(3000)] + [(8, 0, "user", "x" * 300_000 + ".")]
    found = report(spark.createDataFrame(rows, SCHEMA).repartition(6))
    want = wanted(rows)
    assert found == want


def test_empty_and_clashing(spark):
    assert conversations.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, 0, "user", "Hi.", 3, "x"), (1, 1, "assistant", "Yes.", 4, None)]
    frame = spark.createDataFrame(rows, SCHEMA + ", place int, mark string")
    assert conversations.repair_report(frame).first()["audit"] == "KK"
    assert [tuple(r) for r in conversations.repaired_turns(frame).orderBy("place").collect()] == [
        (1, 0, "K", "user", "Hi."), (1, 1, "K", "assistant", "Yes."),
    ]


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"].run(spark, sf_dir).collect()}
    assert got == wanted(rows)
