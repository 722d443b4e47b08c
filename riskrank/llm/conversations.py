"""Conversation structure repair: the cheapest edits that make the roles of a conversation take turns.

Rows are dealt by conversation and sorted by turn, and one stream of batches carries the state of a dynamic program
from batch to batch: the cheapest way to each of four role states, and the order of those ways as strings, which
settles ties. Each row leaves a backpointer of two bytes, whatever its text. When a conversation ends, the pointers are
followed back and its rows are given out with their edits. Pointers and rows of a giant conversation go to a
file of the task while it is open, so memory stays bounded.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# Role states: nothing yet, system, user or assistant last. What an edit costs.
START, SYSTEM, USER, ASSISTANT = range(4)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
KEEP = {
    ("s", START): SYSTEM,
    ("u", START): USER,
    ("u", SYSTEM): USER,
    ("u", ASSISTANT): USER,
    ("a", USER): ASSISTANT,
}
# The state after a turn that may be given any role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
# From any state two insertions lead to ASSISTANT, and there one deletion makes up for what only START can keep.
# A way that costs more than the cheapest by over this is never the cheapest in the end.
WORTHWHILE = 2 * INSERT + DELETE

FAULTS = (None, "blank", "duplicate", "truncated")
EDITS = "conv_id long, place long, edit string, fault string, turn long, was string, role string, text string"
FIGURES = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)

# What is held in memory of one open conversation, before the rest goes to a file.
HELD_BYTES = 8 << 20
HELD_POINTERS = 1 << 20
OUT_BYTES = 4 << 20
OUT_ROWS = 10_000

# Moves by backpointer: for each state, (state before, insertions, edit).
_MOVES: list[tuple] = []


@lru_cache(maxsize=None)
def advance(front: tuple, initial: str, fault: int) -> tuple[tuple, int]:
    """The front after one more row, and the number of its moves in ``_MOVES``.

    A front has (cost above the cheapest, place among the ways as strings) or None for each state. Ways to one
    front end in a row's edit, so none is the beginning of another, and their order holds whatever follows.
    The number of fronts is small, as costs beyond ``WORTHWHILE`` are left out.
    """
    best: list = [None] * 4
    for state, entry in enumerate(front):
        if entry is None:
            continue
        at = state
        for inserts in range(3):
            moves = [("D", at, DELETE)]
            if fault not in (1, 2):
                cut = TRUNCATED if fault == 3 else 0
                moves.append(("R", NEXT[at], REROLE + cut))
                if (initial, at) in KEEP:
                    moves.append(("K", KEEP[initial, at], cut))
            for edit, to, cost in moves:
                way = (entry[0] + INSERT * inserts + cost, entry[1], "I" * inserts + edit, state)
                if best[to] is None or way < best[to]:
                    best[to] = way
            at = NEXT[at]
    least = min(way[0] for way in best if way)
    best = [way if way and way[0] - least <= WORTHWHILE else None for way in best]
    order = sorted(way[1:3] for way in best if way)
    _MOVES.append(tuple(way and (way[3], len(way[2]) - 1, way[2][-1]) for way in best))
    return tuple(way and (way[0] - least, order.index(way[1:3])) for way in best), len(_MOVES) - 1


def finish(front: tuple) -> tuple[int, int]:
    """(state, insertions) of the cheapest way to an end: nothing at all, or an assistant's turn."""
    ends = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    ways = [(entry[0] + INSERT * ends[s], entry[1], s) for s, entry in enumerate(front) if entry]
    state = min(ways)[2]
    return state, ends[state]


class Pointers:
    """Backpointers of an open conversation, two bytes a row; the older ones in a file when there are many."""

    def __init__(self):
        self.recent = array("H")
        self.file = None

    def add(self, pointer: int) -> None:
        self.recent.append(pointer)
        if len(self.recent) >= HELD_POINTERS:
            self.file = self.file or tempfile.TemporaryFile()
            self.recent.tofile(self.file)
            self.recent = array("H")

    def backward(self) -> Iterator[int]:
        yield from reversed(self.recent)
        if self.file:
            step = HELD_POINTERS * self.recent.itemsize
            for at in range(self.file.tell() - step, -1, -step):
                self.file.seek(at)
                yield from reversed(array("H", self.file.read(step)))
            self.file.close()


class Rows:
    """Rows of an open conversation in order; the older ones in a file when they are long."""

    def __init__(self):
        self.recent, self.held, self.file = [], 0, None

    def add(self, row: tuple) -> None:
        self.recent.append(row)
        self.held += 200 + len(row[-1])
        if self.held >= HELD_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(self.recent, self.file)
            self.recent, self.held = [], 0

    def forward(self) -> Iterator[tuple]:
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield from pickle.load(self.file)
            self.file.close()
        yield from self.recent


class Conversation:
    """An open conversation: the front of the dynamic program, and what is needed to go back."""

    def __init__(self):
        self.front = ((0, 0), None, None, None)
        self.pointers, self.rows = Pointers(), Rows()

    def add(self, row: tuple) -> None:
        """``row``: turn, fault (a place in ``FAULTS``), role, text."""
        self.front, moves = advance(self.front, row[2][:1], row[1])
        self.pointers.add(moves)
        self.rows.add(row)

    def edits(self) -> Iterator[tuple]:
        """(edit, fault, turn, was, role, text) in order; of a conversation without rows, one row of nulls."""
        state, after = finish(self.front)
        back = bytearray()
        for pointer in self.pointers.backward():
            state, inserts, edit = _MOVES[pointer][state]
            back.append(inserts << 2 | "DKR".index(edit))
        state = START
        if not back:
            yield (None,) * 6
        for code, (turn, fault, was, text) in zip(reversed(back), self.rows.forward(), strict=True):
            for _ in range(code >> 2):
                state = NEXT[state]
                yield "I", None, None, None, ROLE[state], ""
            edit = "DKR"[code & 3]
            if edit == "D":
                yield edit, FAULTS[fault], turn, was, None, None
            else:
                state = KEEP[was[:1], state] if edit == "K" else NEXT[state]
                yield edit, FAULTS[fault], turn, was, was if edit == "K" else ROLE[state], text
        for _ in range(after):
            state = NEXT[state]
            yield "I", None, None, None, ROLE[state], ""


def _flushed(rows: Iterator[tuple], schema: str) -> Iterator[pd.DataFrame]:
    """Frames of bounded size; the last value of a row is its longest text."""
    fields = [f.split() for f in schema.split(", ")]

    def frame(held: list) -> pd.DataFrame:
        columns = zip(*held, strict=True)
        return pd.DataFrame(
            {n: pd.array(c, dtype="Int64") if t == "long" else pd.Series(c, dtype=object) for (n, t), c in zip(fields, columns, strict=True)}
        )

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or "")
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield frame(held)
            held, size = [], 0
    if held:
        yield frame(held)


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        key, open_ = None, None
        for frame in frames:
            columns = ("no_conv", "conv", "present", "no_turn", "turn", "fault", "role", "text")
            for no_conv, conv, present, no_turn, turn, fault, role, text in zip(*(frame[c].tolist() for c in columns), strict=True):
                if (no_conv, conv) != key:
                    yield from closed(key, open_)
                    key, open_ = (no_conv, conv), Conversation()
                if present:
                    open_.add((None if no_turn else turn, fault, role, text))
        yield from closed(key, open_)

    def closed(key, open_) -> Iterator[tuple]:
        if open_ is not None:
            for place, (edit, *rest) in enumerate(open_.edits()):
                yield None if key[0] else key[1], None if edit is None else place, edit, *rest

    yield from _flushed(rows(), EDITS)


def _last_character(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1))


def repair(
    turns: DataFrame,
    *,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    present: str | None = None,
) -> DataFrame:
    """The edits of every conversation, in order: conv_id, place, edit, fault, turn, was, role, text.

    Edits are K(eep), R(erole to user or assistant), D(elete) and I(nsert with an empty text); those of a
    conversation are the cheapest that leave nothing or an optional system turn and then pairs of user and assistant, the
    least string of edits where several are. ``was`` is the role before; deleted rows have no ``role`` and ``text``. The
    first fault of a row counts: blank, duplicate (role and text seen earlier), truncated (last character no full
    stop, exclamation or question mark).

    Turns are ordered by number, null first, then by role and text. A null role or text counts as one space, rows
    with a null id are one conversation. Repeated rows are duplicates. ``present`` may name a boolean column: rows
    where it is false are not there, but their conversation is returned, as one row of nulls if nothing
    is left. An empty table gives no rows; other columns are ignored. A giant conversation is streamed by one task.
    """
    there = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    words = F.coalesce(F.col(text), F.lit(" "))
    rows = turns.select(
        F.coalesce(F.col(id).cast("long"), F.lit(0)).alias("conv"),
        F.col(id).isNull().alias("no_conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
        F.col(turn).isNull().alias("no_turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        words.alias("text"),
        there.alias("present"),
    )
    order = [F.desc("no_turn"), F.asc("turn")]
    same = Window.partitionBy("conv", "no_conv", "present", "role", F.md5("text")).orderBy(*order)
    last = _last_character(F.col("text"))
    fault = F.when(last == "", 1).when(F.col("nth") > 1, 2).when(~last.isin(*ENDS), 3).otherwise(0)
    judged = rows.withColumn("nth", F.row_number().over(same)).withColumn("fault", fault)
    dealt = judged.repartition("conv", "no_conv").sortWithinPartitions("no_conv", "conv", *order, "role", "text", "nth")
    return dealt.mapInPandas(_stream, EDITS)


# --- figures -----------------------------------------------------------------------------------


class Figures:
    """What a report says of one conversation, added up edit by edit."""

    def __init__(self):
        self.turns = self.first = self.last = self.before = None
        self.faults = dict.fromkeys(FAULTS, 0)
        self.illegal = self.cost = 0
        self.audit, self.digest, self.empty = bytearray(), hashlib.sha256(), True

    def add(self, edit, fault, turn, was, role, text) -> None:
        self.audit += edit.encode()
        if edit != "I":
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.turns, self.last = (self.turns or 0) + 1, turn
            if self.before is not None:
                self.illegal += self.before + was[:1] not in ("su", "ua", "au")
            self.before = was[:1]
            self.faults[fault] += 1
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "D":
            self.cost += TRUNCATED if fault == "truncated" else 0
            self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
            self.empty = False

    def row(self) -> tuple:
        gaps = 0 if self.turns is None else min(self.last - self.first + 1 - self.turns, 2**63 - 1)
        faults = [self.faults[f] for f in FAULTS[1:]]
        return gaps, *faults, self.illegal, self.cost, self.audit.decode(), self.digest.hexdigest()


def _summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows() -> Iterator[tuple]:
        key, figures = None, None
        columns = ("no_conv", "conv", "edit", "fault", "no_turn", "number", "was", "role", "text")
        for frame in frames:
            for no_conv, conv, edit, fault, no_turn, turn, was, role, text in zip(*(frame[c].tolist() for c in columns), strict=True):
                if (no_conv, conv) != key:
                    if figures:
                        yield None if key[0] else key[1], *figures.row()
                    key, figures = (no_conv, conv), Figures()
                if edit is not None:
                    figures.add(edit, fault, None if no_turn else turn, was, role, text)
        if figures:
            yield None if key[0] else key[1], *figures.row()

    yield from _flushed(rows(), FIGURES)


def figures(edits: DataFrame) -> DataFrame:
    """Per conversation of ``repair``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``gaps`` are turn numbers left out between the first and the last one, ``illegal`` neighbouring roles that do not
    follow each other, ``audit`` the edits, and the digest is that of the repaired ``role:text`` lines. Reads the edits as
    ``repair`` gives them: those of a conversation follow each other in one partition, so nothing is shuffled.
    """
    flat = edits.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"), "edit", "fault",
        F.coalesce("turn", F.lit(0)).alias("number"), F.col("turn").isNull().alias("no_turn"), "was", "role", "text",
    )
    return flat.mapInPandas(_summed, FIGURES)


# --- damage ------------------------------------------------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """Known faults in good conversations, by a checksum of id and turn: conv_id, turn, role, text, present.

    Of 20 rows, one each is dropped, emptied, bereft of its full stops, repeated, or given to the user. Nulls count as one
    space.
    """
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
