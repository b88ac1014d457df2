"""Repair of the structure of conversations by the cheapest edits, found with bidirectional Dijkstra.

The turns of a conversation and the states of ``(s?(ua)+)?`` span a lattice: keep (0), give the other role (1), delete
(2) or insert a turn (5) lead from node to node, and a truncated turn that stays adds 5. A forward and a reverse heap
grow towards each other until no cheaper or equally cheap path can cross; of all crossings at the least cost the one
with the ASCII-least audit of edit initials wins.

Rows are collapsed to distinct ones with a count, ordered once by ranges of (conversation, turn), and cut into pieces of
at most ``piece_rows`` rows. A conversation inside one piece is repaired where it is. One that spans pieces, however long,
is solved piece by piece between all pairs of states, the pieces are folded in order, and their texts are hashed as they
stream by: no conversation is ever gathered.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import written

#: Fixed values of the edits: keep, give another role, delete, insert, and what a truncated turn adds if it stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the grammar: nothing yet, after a system turn, after a user turn, after an assistant turn.
STATES = 4
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = {"u": "user", "a": "assistant"}
#: Where a conversation may end.
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
#: Rows of a piece, and characters of its texts, unless a single row has more.
PIECE_ROWS, PIECE_CHARS = 512, 1 << 20
SPACE = " \t\n\x0b\x0c\r"
#: Characters of a text that decide on the range a row is sent to; inside a range whole texts are sorted.
RANGE_CHARS = 64
REST = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


@dataclass(frozen=True)
class Turn:
    """A row of the lattice: initial of its role, whether it must go, whether it breaks off, and how often it is there."""

    initial: str
    drop: bool
    cut: bool
    n: int = 1


Label = tuple[int, str]


def _ahead(turns: list[Turn], node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
    """Edges out of a node (turns used up, state): next node, cost, initials."""
    i, state = node
    for initial in "ua":
        to = NEXT.get((state, initial))
        if to is not None:
            yield (i, to), INSERT, "I"
    if i < len(turns):
        yield from _over(turns[i], i, state)


def _over(turn: Turn, i: int, state: int) -> Iterator[tuple[tuple[int, int], int, str]]:
    yield (i + 1, state), DELETE * turn.n, "D" * turn.n
    if turn.drop:
        return
    # a row that is there several times has copies behind the first one, and those must go
    more, copies = (TRUNCATED if turn.cut else 0) + DELETE * (turn.n - 1), "D" * (turn.n - 1)
    for initial in ("s", "u", "a"):
        to = NEXT.get((state, initial))
        if to is not None:
            if turn.initial == initial:
                yield (i + 1, to), KEEP + more, "K" + copies
            elif initial in ROLES:
                yield (i + 1, to), REROLE + more, "R" + copies


def _behind(turns: list[Turn], node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
    """Edges into a node: node before, cost, initials."""
    i, state = node
    for (before, initial), to in NEXT.items():
        if to == state and initial in ROLES:
            yield (i, before), INSERT, "I"
    if i > 0:
        for before in range(STATES):
            for (_, to), cost, edit in _over(turns[i - 1], i - 1, before):
                if to == state:
                    yield (i - 1, before), cost, edit


class _Side:
    """One of the two searches: labels are final once their node is done.

    Edges that cost nothing use up a turn, so nodes of equal cost are done in the order of turns, and the least audit of
    a node is known when its turn comes.
    """

    def __init__(self, start: list[tuple[int, int]], forward: bool, turns: list[Turn]):
        self.forward, self.turns = forward, turns
        self.labels: dict[tuple[int, int], Label] = {node: (0, "") for node in start}
        self.done: dict[tuple[int, int], Label] = {}
        self.heap = [(0, self._place(node), node) for node in start]
        heapq.heapify(self.heap)

    def _place(self, node: tuple[int, int]) -> int:
        return node[0] if self.forward else -node[0]

    def top(self) -> int | None:
        while self.heap and (self.heap[0][2] in self.done or self.heap[0][0] > self.labels[self.heap[0][2]][0]):
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def step(self) -> tuple[tuple[int, int], Label]:
        _, _, node = heapq.heappop(self.heap)
        cost, audit = self.done[node] = self.labels[node]
        for to, more, edit in (_ahead if self.forward else _behind)(self.turns, node):
            label = (cost + more, audit + edit if self.forward else edit + audit)
            if to not in self.done and (to not in self.labels or label < self.labels[to]):
                if to not in self.labels or label[0] < self.labels[to][0]:
                    heapq.heappush(self.heap, (label[0], self._place(to), to))
                self.labels[to] = label
        return node, self.done[node]


def cheapest(turns: list[Turn], start: int = 0, ends: tuple[int, ...] = ENDS) -> Label | None:
    """Cost and least audit of the cheapest edits from a state to one of the end states; None if there is no way.

    Both searches go on while their tops together don't exceed the best cost met. Then on every cheapest path there is an
    edge whose first node is done forward and whose last node is done in reverse, so all equal crossings are at hand.
    """
    n = len(turns)
    forward, reverse = _Side([(0, start)], True, turns), _Side([(n, end) for end in ends], False, turns)
    best: int | None = None
    while (a := forward.top()) is not None and (b := reverse.top()) is not None and (best is None or a + b <= best):
        side, other = (forward, reverse) if a <= b else (reverse, forward)
        node, (cost, _) = side.step()
        if node in other.labels and (best is None or cost + other.labels[node][0] < best):
            best = cost + other.labels[node][0]
    if best is None:
        return None
    behind, found = {**{(n, end): (0, "") for end in ends}, **reverse.done}, []
    for node, (cost, audit) in forward.done.items():
        if node in behind and cost + behind[node][0] == best:
            found.append(audit + behind[node][1])
        for to, more, edit in _ahead(turns, node):
            if to in behind and cost + more + behind[to][0] == best:
                found.append(audit + edit + behind[to][1])
    return best, min(found)


def lines(audit: str, roles: list[str], texts: list[str], start: int = 0) -> tuple[list[str], int]:
    """The repaired turns as ``role:text``, and the state after them. ``roles`` and ``texts`` have a row for each edit but inserts."""
    out, at, state = [], 0, start
    for edit in audit:
        if edit == "I":
            initial = "a" if state == 2 else "u"
            out.append(f"{ROLES[initial]}:")
            state = NEXT[state, initial]
            continue
        if edit != "D":
            initial = roles[at][:1] if edit == "K" else "a" if state == 2 else "u"
            out.append(f"{roles[at] if edit == 'K' else ROLES[initial]}:{texts[at]}")
            state = NEXT[state, initial]
        at += 1
    return out, state


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of conversations with planted faults, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops a row, 1 empties its text, 2 takes out ``[.!?]``, 3 has it twice, 4 makes it a user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("fault")).filter("fault <> 0")
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    )
    return rows.drop("col")


def _ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number and faults, in ranges of (conversation, turn, role, text); nulls first, no null left.

    Equal rows are summed before they travel. A row is the first of its text if its turn is the least of (conversation,
    role, text); the key that says so is unique on both sides of the join.
    """
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    keys = [F.col("conv_id").isNotNull().alias("has_conv"), number("conv_id").alias("conv"), F.col("turn").isNotNull().alias("has_turn"), number("turn").alias("at")]
    text = F.coalesce("text", F.lit(" "))
    rows = rows.select(*keys, F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"))
    key = ["has_conv", "conv", "has_turn", "at", "role", "h", "g"]
    rows = written(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text")), "turns")
    firsts = rows.groupBy("has_conv", "conv", "role", "h", "g").agg(F.min(F.struct("has_turn", "at")).alias("first"))
    firsts = firsts.select("has_conv", "conv", "first.has_turn", "first.at", "role", "h", "g", F.lit(True).alias("is_first"))
    rows = rows.join(firsts, key, "left")
    filled = F.rtrim(F.col("text"), F.lit(SPACE))
    blank, cut = filled == "", ~F.right(filled, F.lit(1)).isin(".", "!", "?")
    rows = rows.select(
        "has_conv", "conv", "has_turn", "at", "role", "text", "n", blank.alias("blank"), (~blank & F.col("is_first").isNull()).alias("again"),
        (~blank & F.col("is_first").isNotNull() & cut).alias("cut"),
    )
    return _in_ranges(rows, ["has_conv", "conv", "has_turn", "at", "role", "text"])


def _in_ranges(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` in the given order, dealt by ranges of it."""
    ranges = [F.left("text", F.lit(RANGE_CHARS)) if c == "text" else F.col(c) for c in order]
    return rows.repartitionByRange(*ranges).sortWithinPartitions(*order)


@dataclass
class Piece:
    """Consecutive rows of one conversation, with what its fold needs."""

    conv: int | None
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    turns: list[Turn] = field(default_factory=list)
    numbers: list[int | None] = field(default_factory=list)
    chars: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0

    def add(self, number: int | None, role: str, text: str, n: int, blank: bool, again: bool, cut: bool) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.numbers.append(number)
        self.turns.append(Turn(role[:1], blank or again, cut, n))
        self.chars += len(text)
        self.blank += n if blank else 0
        self.duplicate += n if again else 0 if blank else n - 1
        self.truncated += int(cut)

    def full(self, rows: int) -> bool:
        return len(self.turns) >= rows or self.chars >= PIECE_CHARS

    def illegal(self) -> int:
        """Neighbours in the piece that don't follow each other; rows that are there several times are their own neighbours."""
        own = sum(t.n - 1 for t in self.turns if 2 * t.initial not in LEGAL)
        return own + sum(a.initial + b.initial not in LEGAL for a, b in zip(self.turns, self.turns[1:], strict=False))

    def expanded(self) -> tuple[list[str], list[str]]:
        """Roles and texts with a row for every edit that uses one up."""
        if all(t.n == 1 for t in self.turns):
            return self.roles, self.texts
        rows = [i for i, t in enumerate(self.turns) for _ in range(t.n)]
        return [self.roles[i] for i in rows], [self.texts[i] for i in rows]


PIECE_SCHEMA = (
    "conv long, part int, piece int, opens boolean, closes boolean, roles array<string>, texts array<string>, n array<long>, least long, most long, turns long, "
    "blank long, duplicate long, truncated long, illegal long, first string, last string, costs array<long>, audits array<string>"
)
ROW_SCHEMA = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[Piece, bool, bool]]:
    """(piece, opens, closes) of a partition; its first and last conversation may go on in the neighbouring ones."""
    piece, opens = None, True
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for has_conv, conv, has_turn, at, role, text, n, blank, again, cut in zip(*columns, strict=True):
            conv = conv if has_conv else None
            if piece is not None and (piece.conv != conv or piece.full(rows)):
                same = piece.conv == conv
                yield piece, opens, not same
                piece, opens = None, not same
            if piece is None:
                piece = Piece(conv)
            piece.add(at if has_turn else None, role, text, n, blank, again, cut)
    if piece is not None:
        yield piece, opens, True


def _numbers(piece: Piece) -> tuple[int | None, int | None, int]:
    known = [x for x in piece.numbers if x is not None]
    return (min(known), max(known), len(set(known))) if known else (None, None, 0)


def _summed(rows: DataFrame, piece_rows: int) -> DataFrame:
    """A row for every piece: repaired at once if the piece is a whole conversation, else costs and audits between all states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, out = TaskContext.get().partitionId(), []
        count = 0
        stream = _pieces(batches, piece_rows)
        ahead = next(stream, None)
        while ahead is not None:
            (piece, opens, closes), ahead = ahead, next(stream, None)
            # the first conversation of a partition may have begun before it, the last one may go on after it
            inside = opens and closes and count > 0 and ahead is not None
            least, most, turns = _numbers(piece)
            row = {
                "conv": piece.conv, "part": part, "piece": count, "opens": inside, "closes": inside, "n": [t.n for t in piece.turns], "least": least, "most": most,
                "turns": turns, "blank": piece.blank, "duplicate": piece.duplicate, "truncated": piece.truncated, "illegal": piece.illegal(),
                "first": piece.turns[0].initial, "last": piece.turns[-1].initial,
            }
            if inside:
                cost, audit = cheapest(piece.turns)
                text = "\n".join(lines(audit, *piece.expanded())[0])
                row |= {"roles": None, "texts": [hashlib.sha256(text.encode()).hexdigest()], "costs": [cost], "audits": [audit]}
            else:
                ways = [cheapest(piece.turns, a, (b,)) for a in range(STATES) for b in range(STATES)]
                row |= {"roles": piece.roles, "texts": piece.texts, "costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]}
            count += 1
            out.append(row)
            if len(out) == 256 or not inside:
                yield _batch(out, PIECE_SCHEMA)
                out = []
        if out:
            yield _batch(out, PIECE_SCHEMA)

    return written(rows.mapInArrow(run, PIECE_SCHEMA), "pieces")


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64())}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[name] for r in rows], _TYPES[kind]) for name, kind in fields], names=[f[0] for f in fields])


class Fold:
    """The pieces of a conversation so far: counts, and for every state the cheapest way there with its least audit."""

    def __init__(self, conv: int | None):
        self.conv, self.last, self.most = conv, None, None
        self.least, self.turns, self.sums, self.keys = None, 0, [0, 0, 0, 0], []
        self.ways: list[tuple[int, list[str]] | None] = [(0, []), None, None, None]
        self.came: list[list[int]] = []

    def add(self, row: dict) -> None:
        if self.last is not None:
            self.sums[3] += self.last + row["first"] not in LEGAL
        if row["least"] is not None:
            self.turns += row["turns"] - (self.most == row["least"])
            self.least = row["least"] if self.least is None else self.least
            self.most = row["most"]
        self.sums = [a + row[c] for a, c in zip(self.sums, ("blank", "duplicate", "truncated", "illegal"), strict=True)]
        self.last = row["last"]
        ways, came = [], []
        for b in range(STATES):
            options = [(self.ways[a][0] + row["costs"][a * STATES + b], a) for a in range(STATES) if self.ways[a] is not None and row["costs"][a * STATES + b] is not None]
            if not options:
                ways.append(None)
                came.append(-1)
                continue
            cost = min(o[0] for o in options)
            a = min((a for c, a in options if c == cost), key=lambda a: "".join([*self.ways[a][1], row["audits"][a * STATES + b]]))
            ways.append((cost, [*self.ways[a][1], row["audits"][a * STATES + b]]))
            came.append(a)
        self.ways = [w and (w[0], ["".join(w[1])]) for w in ways]
        self.keys.append((row["part"], row["piece"]))
        self.came.append(came)

    def row(self) -> dict:
        end = min((b for b in ENDS if self.ways[b] is not None), key=lambda b: (self.ways[b][0], self.ways[b][1]))
        cost, audit = self.ways[end]
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        states, at = [], end
        for came in reversed(self.came):
            states.append((came[at], at))
            at = came[at]
        out = {"conv": self.conv, "gaps": gaps, "cost": cost, "audit": "".join(audit), "states": states[::-1]}
        return out | dict(zip(("blank", "duplicate", "truncated", "illegal"), self.sums, strict=True))


def _joined(pieces: DataFrame) -> DataFrame:
    """Conversations that span pieces: folded in order, then their texts hashed in order, a piece at a time."""
    columns = "has_conv boolean, conv long, part int, piece int, least long, most long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string, costs array<long>, audits array<string>"
    names = [c.split(" ")[0] for c in columns.split(", ")]
    rows = pieces.filter("NOT opens").select(F.col("conv").isNotNull().alias("has_conv"), F.coalesce("conv", F.lit(0)).alias("conv"), *names[2:])
    schema = ROW_SCHEMA.replace(", repaired_sha256 string", ", part int, piece int, start int, end int")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def given(held: Fold) -> Iterator[pa.RecordBatch]:
            row = held.row()
            for at in range(0, len(held.keys), 4096):
                # the long audit goes with the first piece only
                yield _batch(
                    [
                        row | {"audit": row["audit"] if at + i == 0 else None, "part": part, "piece": piece, "start": row["states"][at + i][0], "end": row["states"][at + i][1]}
                        for i, (part, piece) in enumerate(held.keys[at : at + 4096])
                    ],
                    schema,
                )

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i].as_py() for c, name in enumerate(names)}
                conv = row["conv"] if row["has_conv"] else None
                if held is not None and held.conv != conv:
                    yield from given(held)
                    held = None
                held = held or Fold(conv)
                held.add(row)
        if held is not None:
            yield from given(held)

    order = ["has_conv", "conv", "part", "piece"]
    folded = written(rows.repartition("has_conv", "conv").sortWithinPartitions(*order).mapInArrow(fold, schema), "folded")
    # every piece with its own part of the audit and its texts, hashed in order
    way = F.col("start") * STATES + F.col("end") + 1
    chosen = pieces.filter("NOT opens").drop("conv").join(folded.select("conv", "part", "piece", "start", "end"), ["part", "piece"])
    chosen = chosen.select(F.col("conv").isNotNull().alias("has_conv"), F.coalesce("conv", F.lit(0)).alias("conv"), "part", "piece", "start", F.element_at("audits", way).alias("own"), "roles", "texts", "n")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, begun = None, None, False
        for batch in batches:
            for i in range(batch.num_rows):
                has_conv, conv, _, _, start, own, roles, texts, n = (c[i].as_py() for c in batch.columns)
                if key != (has_conv, conv):
                    if key is not None:
                        yield _batch([{"conv": key[1] if key[0] else None, "sha": sha.hexdigest()}], "conv long, sha string")
                    key, sha, begun = (has_conv, conv), hashlib.sha256(), False
                rows = [j for j, k in enumerate(n) for _ in range(k)]
                for line in lines(own, [roles[j] for j in rows], [texts[j] for j in rows], start)[0]:
                    sha.update(("\n" if begun else "").encode() + line.encode())
                    begun = True
        if key is not None:
            yield _batch([{"conv": key[1] if key[0] else None, "sha": sha.hexdigest()}], "conv long, sha string")

    digests = chosen.repartition("has_conv", "conv").sortWithinPartitions(*order).mapInArrow(digest, "conv long, sha string")
    whole = folded.filter("audit IS NOT NULL").select("conv", *REST, "audit")
    return whole.join(digests.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).select("conv", *REST, "audit", F.col("sha").alias("repaired_sha256"))


def repaired(rows: DataFrame, conversations: DataFrame | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    Rows are taken by turn (nulls first; equal turns by role and text); null roles and texts are one space, a null
    conv_id is a conversation of its own. Extra columns are not read. ``conversations`` (conv_id) adds those without any
    row: zeros, an empty audit and the hash of an empty text. Roles other than system, user and assistant keep their
    text only if their initial is one of ``s``, ``u``, ``a``. Conversations of equal ids are one.
    """
    pieces = _summed(_ordered(rows), piece_rows)
    whole = pieces.filter("opens").select(
        "conv", F.when(F.col("least").isNull(), 0).otherwise(F.col("most") - F.col("least") + 1 - F.col("turns")).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"), F.col("texts")[0].alias("repaired_sha256"),
    )
    found = whole.unionByName(_joined(pieces))
    if conversations is None:
        return found.withColumnRenamed("conv", "conv_id")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    nothing: dict[str, Column] = {c: F.lit(0).cast("long") for c in REST} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return found.select("conv_id", *[F.coalesce(c, v).alias(c) for c, v in nothing.items()])


def repaired_turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place, role, text of the repaired conversations, from the rows and the audits of :func:`repaired`.

    Every edit but an insert uses up the next row, so rows meet their edit by their place and roles follow from the state.
    A conversation's edits stream in order; nothing but the state is held.
    """
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    audits = found.select(F.col("conv_id").isNotNull().alias("has_conv"), number("conv_id").alias("conv"), F.posexplode(F.split("audit", "")).alias("edit_at", "edit")).filter("edit <> ''")
    rows = rows.select(F.col("conv_id").isNotNull().alias("has_conv"), number("conv_id").alias("conv"), F.col("turn").isNotNull().alias("has_turn"), number("turn").alias("at"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = _placed(rows, ["has_conv", "conv"], ["has_turn", "at", "role", "text"], "used")
    used = _placed(audits.filter("edit <> 'I'"), ["has_conv", "conv"], ["edit_at"], "used")
    key = ["has_conv", "conv", "used"]
    edits = used.join(rows.select(*key, "role", "text"), key).select("has_conv", "conv", "edit_at", "edit", "role", "text").filter("edit <> 'D'")
    inserted = audits.filter("edit = 'I'").select("has_conv", "conv", "edit_at", "edit", F.lit(None).cast("string").alias("role"), F.lit("").alias("text"))
    edits = _placed(edits.unionByName(inserted), ["has_conv", "conv"], ["edit_at"], "place")
    first = edits.filter("place = 0").select("has_conv", "conv", ((F.col("edit") == "K") & F.col("role").startswith("s")).cast("int").alias("off"))
    turn = F.when((F.col("place") - F.col("off")) % 2 == 0, "user").otherwise("assistant")
    role = F.when(F.col("edit") == "K", F.col("role")).otherwise(turn)
    return edits.join(first, ["has_conv", "conv"]).select(F.when(F.col("has_conv"), F.col("conv")).alias("conv_id"), "place", role.alias("role"), "text")


def _placed(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in their group; a group of any size is spread over ranges of the order."""
    rows = _in_ranges(rows, [*group, *order]).withColumn("_id", F.monotonically_increasing_id())
    rows = written(rows, "placed").withColumn("_part", F.shiftright("_id", 33))
    parts = rows.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_least"))
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.select(*group, "_part", "_least", (F.sum("_n").over(ahead) - F.col("_n")).alias("_base"))
    return rows.join(parts, [*group, "_part"]).withColumn(name, F.col("_base") + F.col("_id") - F.col("_least")).drop("_id", "_part", "_least", "_base")
