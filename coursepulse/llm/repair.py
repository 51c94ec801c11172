"""Cheapest repair of a conversation's order of roles.

A repaired conversation is empty, or an optional system turn followed by pairs of a user and an
assistant turn. Each turn is kept, given the other role, or deleted, and empty turns may be inserted
anywhere; of the cheapest ways the one with the ASCII-least string of edit letters is taken.

What is left to pay from a place in the conversation depends only on the role expected there, so it is
a vector of four costs, worked out from the end. Going backward, only checkpoints are stored: the
vector after each block, with the block's turns as one byte each. Blocks grow with the square root of
the turns passed, so a conversation of n turns has some 1.4 * sqrt(n) of them, none of more than
1.4 * sqrt(n) turns. Going forward, a block's vectors are worked out anew from its checkpoint, and each
step takes the least letter that is tight, that is, whose cost is what the vectors lose by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from coursepulse.llm.folders import working_dir
from coursepulse.workspace import stored

DELETE, INSERT, KEEP, REROLE = "DIKR"
_DELETE_COST, _INSERT_COST, _REROLE_COST, _TRUNCATED_COST = 2, 5, 1, 5

#: What came last: nothing, a system, a user, or an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state an inserted or re-roled turn leads to, and the role it gets.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state a kept turn leads to, by the state before and the initial of its role.
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
_INITIALS = "sua"
_LEGAL = {"su", "ua", "au"}

FAULTS = ("", "blank", "duplicate", "truncated")
_FINE, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
_WHITE = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


class Edit(NamedTuple):
    letter: str
    cost: int
    state: int


def _inserted(costs: list[int]) -> Vector:
    """The costs when turns may also be inserted first; two lead anywhere that inserting leads."""
    return tuple(min(costs[s], _INSERT_COST + costs[_NEXT[s]],
                     2 * _INSERT_COST + costs[_NEXT[_NEXT[s]]]) for s in range(4))


#: Behind the last turn: nothing may be open.
END: Vector = _inserted([0, 10 ** 9, 10 ** 9, 0])


def _edits(code: int, state: int) -> list[Edit]:
    """What may be done with a turn, the least letter first. A code is an initial and a fault."""
    initial, fault = code >> 2, code & 3
    found = [Edit(DELETE, _DELETE_COST, state)]
    if fault in (_BLANK, _DUPLICATE):
        return found
    more = _TRUNCATED_COST if fault == _TRUNCATED else 0
    letter = _INITIALS[initial] if initial < 3 else ""
    kept = _KEPT.get((state, letter))
    if kept is not None:
        found.append(Edit(KEEP, more, kept))
    if _ROLE[_NEXT[state]][0] != letter:
        found.append(Edit(REROLE, _REROLE_COST + more, _NEXT[state]))
    return found


#: Edits by code and state.
_EDITS = [[_edits(code, state) for state in range(4)] for code in range(16)]


def before(code: int, after: Vector) -> Vector:
    """The costs before a turn from those behind it."""
    return _inserted([min(edit.cost + after[edit.state] for edit in edits)
                      for edits in _EDITS[code]])


def vectors(codes: bytes, after: Vector) -> list[Vector]:
    """The costs before each turn of a block, and behind its last."""
    found = [after]
    for code in reversed(codes):
        found.append(before(code, found[-1]))
    return found[::-1]


class Backward:
    """Reads a conversation's turns from the last to the first and gives its blocks, which have
    ``least`` turns or more but for the last."""

    def __init__(self, least: int = 64) -> None:
        self.least, self.vector, self.after = least, END, END
        self.codes, self.turns, self.place = bytearray(), 0, None

    def turn(self, code: int, place: int) -> tuple[int, bytes, Vector] | None:
        self.codes.append(code)
        self.turns += 1
        self.place, self.vector = place, before(code, self.vector)
        size = len(self.codes)
        return self.close() if size >= self.least and size * size >= self.turns else None

    def close(self) -> tuple[int, bytes, Vector] | None:
        """The block read so far: place of its first turn, codes in order, checkpoint."""
        if not self.codes:
            return None
        block = self.place, bytes(reversed(self.codes)), self.after
        self.codes, self.after = bytearray(), self.vector
        return block


class Forward:
    """Walks a conversation from its first turn on; blocks are given before their turns."""

    def __init__(self) -> None:
        self.state, self.vectors, self.codes, self.at = START, [END], b"", 0
        self.cost = 0

    def block(self, codes: bytes, after: Vector) -> None:
        self.codes, self.at, self.vectors = codes, 0, vectors(codes, after)

    def _insertions(self) -> Iterator[Edit]:
        costs = self.vectors[self.at]
        while _INSERT_COST + costs[_NEXT[self.state]] == costs[self.state]:
            self.state = _NEXT[self.state]
            self.cost += _INSERT_COST
            yield Edit(INSERT, _INSERT_COST, self.state)

    def turn(self) -> Iterator[Edit]:
        """The edits up to the next turn's own, which is the last of them."""
        code = self.codes[self.at]
        costs, after = self.vectors[self.at], self.vectors[self.at + 1]
        while True:
            tight = next((e for e in _EDITS[code][self.state]
                          if e.cost + after[e.state] == costs[self.state]), None)
            if tight is not None and tight.letter == DELETE:
                break
            inserted = next(self._insertions(), None)  # less than keeping, more than deleting
            if inserted is None:
                break
            yield inserted
        self.at += 1
        self.state = tight.state
        self.cost += tight.cost
        yield tight

    def close(self) -> Iterator[Edit]:
        """The insertions behind the last turn."""
        return self._insertions()

    @property
    def fault(self) -> int:
        """The fault of the next turn."""
        return self.codes[self.at] & 3


# --- tables ---------------------------------------------------------------------------------


def _placed(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, place``: written in order, places rising with conversation, turn
    (nulls first), role and text. The sort is by ranges, so a long conversation is spread, and so are
    equal rows, by where they were read."""
    space = F.lit(" ")
    named = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), F.monotonically_increasing_id().alias("read_at"))
    order = ["conv_id", "turn", "role", "text", "read_at"]
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order).drop("read_at")
    return stored(ordered.withColumn("place", F.monotonically_increasing_id()),
                  working_dir(rows.sparkSession, "turns"))


def _coded(placed: DataFrame) -> DataFrame:
    """``conv_id, place, code``. The first of equal turns is found by a digest; whether a turn is one
    is then looked up by its place, a key of one row."""
    text = F.rtrim(F.col("text"), F.lit(_WHITE))
    truncated = ~F.substring(text, -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    known = F.lit(3)
    for number, letter in enumerate(_INITIALS):
        known = F.when(initial == letter, number).otherwise(known)
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
                    .cast("binary"), 256)
    firsts = placed.groupBy("conv_id", digest.alias("digest")).agg(
        F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = (F.when(text == "", _BLANK).when(F.col("first").isNull(), _DUPLICATE)
             .when(truncated, _TRUNCATED).otherwise(_FINE))
    return placed.join(firsts, "place", "left").select(
        "conv_id", "place", (known * 4 + fault).cast("int").alias("code"))


_WHOLE, _STRING = pa.int64(), pa.string()
_BLOCKS = pa.schema([("conv_id", _WHOLE), ("place", _WHOLE), ("codes", pa.binary()),
                     ("after", pa.list_(_WHOLE))])


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the conversations whose codes come from the last to the first."""
    conversation, walk = None, None
    for batch in batches:
        blocks = []
        for key, place, code in zip(*(batch[name].to_pylist()
                                      for name in ("conv_id", "place", "code"))):
            if walk is None or key != conversation:
                if walk is not None:
                    blocks.append((conversation, walk.close()))
                conversation, walk = key, Backward()
            blocks.append((key, walk.turn(code, place)))
        yield _batch([(key, *block) for key, block in blocks if block], _BLOCKS)
    if walk is not None and (block := walk.close()):
        yield _batch([(conversation, *block)], _BLOCKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.record_batch([pa.array(column, field.type)
                            for column, field in zip(columns, schema)], schema=schema)


def _walked(rows: DataFrame, consume: Callable, schema: pa.Schema) -> DataFrame:
    """Applies ``consume`` to streams of blocks and turns in order."""
    placed = _placed(rows)
    blocks = _coded(placed).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc("place")).mapInArrow(_checkpoints, from_arrow_schema(_BLOCKS))
    none = F.lit(None)
    both = placed.select(
        "conv_id", "place", "turn", "role", "text", none.cast("binary").alias("codes"),
        none.cast("array<long>").alias("after"),
    ).unionByName(blocks.select(
        "conv_id", "place", none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("text"), "codes", "after"))
    ordered = both.repartition("conv_id").sortWithinPartitions(
        "conv_id", "place", F.col("codes").isNull())
    return ordered.mapInArrow(consume, from_arrow_schema(schema))


class _Step(NamedTuple):
    """A turn with the edits that end with its own; the last step of a conversation has no turn."""

    key: int | None
    new: bool
    turn: int | None
    role: str | None
    text: str | None
    fault: int
    edits: list[Edit]
    walk: Forward


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[_Step]:
    """All turns in order, and one step without a turn behind each conversation's last."""
    conversation, walk, new = None, None, False
    for batch in batches:
        for key, turn, role, text, codes, after in zip(*(
                batch[name].to_pylist()
                for name in ("conv_id", "turn", "role", "text", "codes", "after"))):
            if walk is None or key != conversation:
                if walk is not None:
                    yield _Step(conversation, False, None, None, None, 0, list(walk.close()), walk)
                conversation, walk, new = key, Forward(), True
            if codes is not None:
                walk.block(codes, tuple(after))
                continue
            fault = walk.fault
            yield _Step(key, new, turn, role, text, fault, list(walk.turn()), walk)
            new = False
    if walk is not None:
        yield _Step(conversation, False, None, None, None, 0, list(walk.close()), walk)


def _outcome(step: _Step) -> Iterator[tuple[str, int | None, str, str]]:
    """Letter, turn, role and text of the turns that a step leaves."""
    for edit in step.edits:
        if edit.letter == INSERT:
            yield INSERT, None, _ROLE[edit.state], ""
        elif edit.letter == KEEP:
            yield KEEP, step.turn, step.role, step.text
        elif edit.letter == REROLE:
            yield REROLE, step.turn, _ROLE[edit.state], step.text


def _batches(rows: Iterator[tuple], schema: pa.Schema,
             most: int = 2000, most_chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Batches of so many rows, or characters, at most."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(value) for value in row if isinstance(value, str))
        if len(held) == most or chars > most_chars:
            yield _batch(held, schema)
            held, chars = [], 0
    yield _batch(held, schema)


_TURNS = pa.schema([("conv_id", _WHOLE), ("position", _WHOLE), ("edit", _STRING),
                    ("turn", _WHOLE), ("role", _STRING), ("text", _STRING)])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        position = 0
        for step in _steps(batches):
            if step.new:
                position = 0
            for left in _outcome(step):
                yield step.key, position, *left
                position += 1
    yield from _batches(rows(), _TURNS)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The turns of the repaired conversations, see :func:`repair_report`; deleted ones are left out.

    ``position`` counts from 0; ``edit`` is the letter of what was done; an inserted turn has no number.
    """
    return _walked(rows, _repaired, _TURNS)


class _Report:
    """What is counted over one conversation."""

    def __init__(self, key) -> None:
        self.key, self.faults, self.illegal = key, [0] * len(FAULTS), 0
        self.first = self.last = self.role = None
        self.turns, self.audit, self.empty = 0, [], True
        self.digest = hashlib.sha256()

    def add(self, step: _Step) -> None:
        self.audit.extend(edit.letter for edit in step.edits)
        for _, _, role, text in _outcome(step):
            self.digest.update((f"{role}:{text}" if self.empty else f"\n{role}:{text}").encode())
            self.empty = False
        if step.role is None:
            return
        self.faults[step.fault] += 1
        if self.role is not None and self.role[:1] + step.role[:1] not in _LEGAL:
            self.illegal += 1
        self.role = step.role
        if step.turn is not None:
            if self.last != step.turn:
                self.turns += 1
            self.first = step.turn if self.first is None else self.first
            self.last = step.turn

    def row(self, cost: int) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.key, gaps, *self.faults[1:], self.illegal, cost, "".join(self.audit),
                self.digest.hexdigest())


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = pa.schema([("conv_id", _WHOLE), *[(name, _WHOLE) for name in _COUNTS],
                     ("audit", _STRING), ("repaired_sha256", _STRING)])


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        report = None
        for step in _steps(batches):
            if step.new:
                report = _Report(step.key)
            report.add(step)
            if step.role is None:
                yield report.row(step.walk.cost)
    yield from _batches(rows(), _REPORT)


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation: its faults, the cheapest repair as a string of letters, and a digest of what
    is then left.

    ``conv_id, turn, role, text`` are read; other columns are ignored. A null role or text is one
    space. Turns go by number, nulls first, those of one number by role, then text. Rows without a
    conversation id form one conversation without an id. A turn's fault is the first of: blank (white
    space only), duplicate (an earlier turn has the same role and text), truncated (its last character
    that isn't white space is none of ``.!?``). Blank and duplicate turns are deleted. ``gaps`` counts
    the numbers that are missing between the least and the greatest, ``illegal`` the neighbours whose
    roles don't follow each other. An empty table has no conversations.

    A conversation's digest is sequential, so one task reads its turns, one at a time; it holds
    vectors of one block, and the letters.
    """
    return _walked(rows, _reported, _REPORT)


def damage(rows: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn, in twentieths: dropped, emptied, without ends of
    sentences, repeated, or given to the user; nulls of role and text are one space."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20

    def when(number: int, then: Column, otherwise: Column) -> Column:
        return F.when(kind == number, then).otherwise(otherwise)

    return rows.filter(kind != 0).select(
        "conv_id", "turn", when(4, F.lit("user"), role).alias("role"),
        when(1, F.lit(""), when(2, F.regexp_replace(text, "[.!?]", ""), text)).alias("text"),
        F.explode(when(3, F.array(F.lit(0), F.lit(1)), F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def damaged_report(conversations: DataFrame) -> DataFrame:
    """The report on :func:`damage` done to ``conversations``, with a row for each original one."""
    report = repair_report(damage(conversations))
    ids = conversations.select("conv_id").distinct()
    zero, nothing = F.lit(0).cast("long"), hashlib.sha256().hexdigest()
    return ids.join(report.withColumnRenamed("conv_id", "id"),
                    F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *[F.coalesce(name, zero).alias(name) for name in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
