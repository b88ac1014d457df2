"""Conversation repair against an enumeration of edits and a plain walk over the grammar."""

import hashlib
import random
import re
import zlib

import pytest

from peoplelake.llm import conversations
from peoplelake.llm.conversations import Turn, cheapest

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, audit string, n int"
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def enumerated(turns):
    """(cost, audit) by trying every string of edits with up to three inserts."""
    rows = [r for t in turns for r in [t, *[Turn(t.initial, True, False)] * (t.n - 1)]]
    best = (10**9, "")

    def go(i, initials, cost, audit, inserts):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(rows) and GRAMMAR.match(initials):
            best = min(best, (cost, audit))
        for x in "ua" if inserts < 3 else "":
            go(i, initials + x, cost + 5, audit + "I", inserts + 1)
        if i < len(rows):
            go(i + 1, initials, cost + 2, audit + "D", inserts)
            if not rows[i].drop:
                stays = cost + 5 * rows[i].cut
                go(i + 1, initials + rows[i].initial, stays, audit + "K", inserts)
                for x in "ua":
                    go(i + 1, initials + x, stays + 1, audit + "R", inserts)

    go(0, "", 0, "", 0)
    return best


def test_cheapest_against_enumeration():
    rng = random.Random(1)
    for _ in range(400):
        turns = [Turn(rng.choice("suauat"), rng.random() < 0.15, False, rng.choice([1, 1, 1, 2, 3])) for _ in range(rng.randint(0, 5))]
        turns = [Turn(t.initial, t.drop, not t.drop and rng.random() < 0.25, t.n) for t in turns]
        assert cheapest(turns) == enumerated(turns)


def walked(turns):
    """(cost, audit, lines) by a forward walk over (state, rows used): the least of all ways at every node."""
    states = {0: (0, "", ())}

    def least(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserts(ways):
        for _ in range(3):
            for state, (cost, audit, out) in list(ways.items()):
                for initial, word in (("u", "user:"), ("a", "assistant:")):
                    to = {(0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))
                    if to:
                        least(ways, to, (cost + 5, audit + "I", (*out, word)))
        return ways

    states = inserts(states)
    for role, text, drop, cut in turns:
        ways = {}
        for state, (cost, audit, out) in states.items():
            least(ways, state, (cost + 2, audit + "D", out))
            for initial, word in (("s", None), ("u", "user"), ("a", "assistant")) if not drop else ():
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))
                if to and role[:1] == initial:
                    least(ways, to, (cost + 5 * cut, audit + "K", (*out, f"{role}:{text}")))
                elif to and word:
                    least(ways, to, (cost + 1 + 5 * cut, audit + "R", (*out, f"{word}:{text}")))
        states = inserts(ways)
    return min(states[s] for s in (0, 3) if s in states)


def expected(rows, damage=True):
    """The result by definition, conversation by conversation."""
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, [])
        space = lambda x: " " if x is None else x
        role, text = space(role), space(text)
        fault = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20 if damage else 19
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        by[conv] += [(turn is not None, turn or 0, role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, kept in by.items():
        kept.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, _, role, text in kept:
            found = SPACE.findall(text)
            kind = 0 if not found else 1 if (role, text) in seen else 2 if found[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                counts[kind] += 1
            turns.append((role, text, kind in (0, 1), kind == 2))
        numbers = [t for has, t, *_ in kept if has]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit, lines = walked(turns)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines)
    return out


def random_rows(seed, conversations=60, length=12):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "well", "", " \t\r\n", "a\x0bb.", "Ünï…", "日本。", "ok. \n ", "x"]
    roles = ["user", "assistant", "system", "tool", None, "", "u", "S"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(0, length)):
            role = rng.choice(roles) if rng.random() < 0.2 else ["user", "assistant"][turn % 2]
            rows.append((None if conv == 5 else conv, None if rng.random() < 0.05 else turn - 2, role, rng.choice([*texts, None, f"turn {turn}."]), "x", 3))
    rows += rows[:25] + [(900, 1, "user", "Twice.", "", 0)] * 7 + [(901, None, None, None, None, None)] * 2
    return rows


def compare(spark, rows, damage, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    faulty = conversations.damaged(table) if damage else table
    found = conversations.repaired(faulty, table.select("conv_id"), **options)
    got = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    want = expected(rows, damage)
    assert got == {c: w[:-1] for c, w in want.items()}
    return faulty, found, want


@pytest.mark.parametrize("damage", [True, False])
def test_repair_against_definition(spark, damage):
    faulty, found, want = compare(spark, random_rows(4), damage)
    turns = {}
    for r in conversations.repaired_turns(faulty, found).collect():
        turns.setdefault(r.conv_id, []).append((r.place, f"{r.role}:{r.text}"))
    lines = {c: tuple(text for _, text in sorted(t)) for c, t in turns.items()}
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}


def test_long_conversations_are_cut_into_pieces(spark):
    rng = random.Random(9)
    rows = [(1, t, ["user", "assistant"][t % 2] if rng.random() < 0.8 else "system", rng.choice([f"Turn {t}.", f"turn {t}", "Again.", ""]), "", 0) for t in range(1500)]
    rows += [(2, 0, "user", "Same.", "", 0)] * 1200 + [(3, None, "user", f"No number {i}.", "", 0) for i in range(300)] + random_rows(2, 20)
    compare(spark, rows, True, piece_rows=16)


def test_no_rows(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert conversations.repaired(conversations.damaged(table), table.select("conv_id")).collect() == []
    ids = spark.createDataFrame([(7,), (None,), (7,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(map(tuple, conversations.repaired(table, ids).collect()), key=repr) == [(7, 0, 0, 0, 0, 0, 0, "", empty), (None, 0, 0, 0, 0, 0, 0, "", empty)]
