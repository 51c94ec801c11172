"""Chat formatting of turns made of typed content parts.

A visitor flattens a turn's parts in order: text is escaped, an image, audio clip or document becomes
a numbered placeholder, whose reference and expanded token count are recorded. A turn is written as

    ### Assistant: text </turn>

and a line end. Within texts and roles ``\\``, ``#`` and ``<`` (and ``:`` in roles) get a backslash,
so that no marker or placeholder can be forged and every text can be read back exactly. The loss
mask is the span of the assistant's content.

Conversations stream through a task sorted by id and turn; what is held is one turn, not one
conversation. The turns of one conversation are read by one task, because their digest is sequential.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", " </turn>\n"
TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
_ROLES = {title: role for role, title in TITLES.items()}

_ESCAPED = re.compile(r"[\\#<]")
_ESCAPED_ROLE = re.compile(r"[\\#<:]")
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"### ((?:[^\\:]++|\\.)*+): ", re.DOTALL)
_BODY = re.compile(r"(?:[^\\<]++|\\.|<(?!/turn>))*+</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


# --- typed parts ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Text:
    text: str

    def accept(self, visitor):
        return visitor.text(self)


@dataclass(frozen=True)
class Image:
    """``tokens`` of a picture of ``width`` by ``height``: one per started tile."""

    ref: str
    width: int = 0
    height: int = 0
    tile: int = 28

    @property
    def tokens(self) -> int:
        return max(1, -(-self.width // self.tile)) * max(1, -(-self.height // self.tile))

    def accept(self, visitor):
        return visitor.attachment("image", self)


@dataclass(frozen=True)
class Audio:
    ref: str
    seconds: float = 0.0
    rate: int = 25

    @property
    def tokens(self) -> int:
        return max(1, -int(-self.seconds * self.rate // 1))

    def accept(self, visitor):
        return visitor.attachment("audio", self)


@dataclass(frozen=True)
class Document:
    ref: str
    pages: int = 1
    per_page: int = 256

    @property
    def tokens(self) -> int:
        return max(1, self.pages) * self.per_page

    def accept(self, visitor):
        return visitor.attachment("document", self)


Part = Text | Image | Audio | Document


@dataclass
class Flattener:
    """Visits the parts of a turn in order. Numbers go on from ``first``."""

    first: int = 0
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def text(self, part: Text) -> None:
        self.pieces.append(escape(part.text))

    def attachment(self, kind: str, part) -> None:
        number = self.first + len(self.attachments)
        self.pieces.append(f"<{kind}:{number}>")
        self.attachments.append(
            {"number": number, "kind": kind, "ref": part.ref, "tokens": part.tokens})

    def visit(self, parts: Iterable[Part]) -> str:
        for part in parts:
            part.accept(self)
        return "".join(self.pieces)


def part_of(row: dict) -> Part:
    """A part from its row: ``kind`` and the fields of that kind; null text counts as empty."""
    kind, ref = row.get("kind") or "text", row.get("ref") or ""
    if kind == "text":
        return Text(row.get("text") or "")
    if kind == "image":
        return Image(ref, int(row.get("width") or 0), int(row.get("height") or 0))
    if kind == "audio":
        return Audio(ref, float(row.get("seconds") or 0))
    if kind == "document":
        return Document(ref, int(row.get("pages") or 1))
    raise ValueError(f"unknown part kind: {kind}")


# --- writing --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Turn:
    """A written turn, where it starts in its conversation, and its loss span (empty if none)."""

    formatted: str
    start: int
    loss: tuple[int, int]
    attachments: list[dict]


class Writer:
    """Writes the turns of one conversation after another."""

    def __init__(self) -> None:
        self.length, self.attached = 0, 0

    def turn(self, role: str | None, parts: Iterable[Part]) -> Turn:
        role = role or ""
        title = TITLES.get(role)
        if title is None:
            title = _ESCAPED_ROLE.sub(r"\\\g<0>", role)
            if role in _ROLES:  # a role that looks like a known role's title
                title = "\\" + title
        flat = Flattener(self.attached)
        body = flat.visit(parts)
        head = f"{OPEN}{title}: "
        formatted = head + body + CLOSE
        start = self.length
        at = start + len(head)
        loss = (at, at + len(body)) if role == "assistant" else (at, at)
        self.length += len(formatted)
        self.attached += len(flat.attachments)
        return Turn(formatted, start, loss, flat.attachments)


# --- reading back ---------------------------------------------------------------------------


class Reader:
    """Reads turns out of formatted text that arrives in pieces of any length."""

    def __init__(self) -> None:
        self.rest, self.at = "", 0

    def feed(self, piece: str) -> Iterator[tuple[str, str, int, int]]:
        """``(role, escaped body, from, to)`` of the turns complete so far."""
        self.rest += piece
        while self.rest:
            head = _HEAD.match(self.rest)
            body = head and _BODY.match(self.rest, head.end())
            if not body:
                return
            title = head[1]
            role = _ROLES.get(title) or unescape(title)
            stop = body.end() - len(CLOSE)
            yield role, self.rest[head.end():stop], self.at + head.end(), self.at + stop
            self.at += body.end()
            self.rest = self.rest[body.end():]


def read_parts(body: str, attachments: dict[int, Part] | None = None) -> list[Part]:
    """The parts of an escaped body; placeholders are looked up in ``attachments``."""
    parts: list[Part] = []
    last = 0
    for found in re.finditer(r"\\.|<(?:image|audio|document):(\d+)>", body, re.DOTALL):
        if found[1] is None:
            continue
        if found.start() > last:
            parts.append(Text(unescape(body[last : found.start()])))
        parts.append((attachments or {})[int(found[1])])
        last = found.end()
    if last < len(body):
        parts.append(Text(unescape(body[last:])))
    return parts


# --- tables ---------------------------------------------------------------------------------


def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _parts(row) -> list[Part]:
    """The parts of a row: those of its ``parts`` column if it has any, else its text."""
    given = getattr(row, "parts", None)
    if given is not None:
        return [part_of(dict(part) if isinstance(part, dict) else part.asDict())
                for part in given]
    return [Text(row.text if isinstance(row.text, str) else "")]


def _written(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, str | None, Turn]]:
    """Conversation id, first-of-conversation flag and turn, for rows in order."""
    conversation, writer = None, None
    for batch in batches:
        for row in batch.itertuples(index=False):
            key = None if pd.isna(row.conv_id) else int(row.conv_id)
            if writer is None or key != conversation:
                conversation, writer = key, Writer()
            role = row.role if isinstance(row.role, str) else ""
            yield key, writer, writer.turn(role, _parts(row))


_FORMATTED = (
    "conv_id long, position long, formatted string, start long, loss_from long, loss_to long, "
    "attachments array<struct<number:int,kind:string,ref:string,tokens:long>>")


def format_turns(rows: DataFrame) -> DataFrame:
    """One row per turn with its part of the conversation's formatted text.

    Reads ``conv_id, turn, role, text`` and, where there is one, ``parts`` (an array of structs with
    ``kind`` and its fields), which then replaces the text. Other columns are ignored. The pieces in
    the order of ``position`` are the whole text; ``start`` and the loss span count its code points.
    Null roles and texts are empty; turns of the same number go by role, then text; rows without a
    conversation id form one conversation without an id.
    """
    names = ["conv_id", "turn", "role", "text", *(["parts"] if "parts" in rows.columns else [])]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def in_order():
            last, position = None, 0
            for key, writer, turn in _written(batches):
                position = position + 1 if writer is last else 0
                last = writer
                yield (key, position, turn.formatted, turn.start, *turn.loss, turn.attachments)

        yield from _in_frames(in_order(), [
            "conv_id", "position", "formatted", "start", "loss_from", "loss_to", "attachments"])

    return _by_conversation(rows.select(*names)).mapInPandas(write, _FORMATTED)


def _in_frames(rows: Iterator[tuple], names: list[str], most: int = 2000) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _frame(held, names)
            held = []
    if held:
        yield _frame(held, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})


class Digest:
    """What a conversation holds, read back from its formatted text piece by piece."""

    def __init__(self) -> None:
        self.reader, self.turns, self.chars, self.masked = Reader(), 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.spans: list[tuple[int, int]] = []

    def feed(self, formatted: str, loss: tuple[int, int]) -> None:
        self.chars += len(formatted)
        if loss[1] > loss[0]:
            self.spans.append(loss)
        for role, body, start, stop in self.reader.feed(formatted):
            text = unescape(body)
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            while self.spans and self.spans[0][0] < stop:
                low, high = self.spans.pop(0)
                if low < start or high > stop:
                    raise ValueError("a loss span crosses the bounds of a turn")
                masked = unescape(body[low - start : high - start])
                self.masked += len(masked)
                self.loss.update(masked.encode())

    def row(self, key) -> tuple:
        if self.reader.rest or self.spans:
            raise ValueError("the formatted text does not end with a turn")
        return (key, self.turns, self.all.hexdigest(), self.masked, self.loss.hexdigest(),
                self.chars)


def format_digests(rows: DataFrame,
                   digest: Callable[[], Digest] = Digest) -> DataFrame:
    """Per conversation: formats its turns as :func:`format_turns` does, reads the formatted text
    and its loss mask back, and returns counts and digests of what was read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def in_order():
            last, key, held = None, None, None
            for now, writer, turn in _written(batches):
                if writer is not last:
                    if held is not None:
                        yield held.row(key)
                    last, key, held = writer, now, digest()
                held.feed(turn.formatted, turn.loss)
            if held is not None:
                yield held.row(key)

        yield from _in_frames(in_order(), [
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    names = ["conv_id", "turn", "role", "text", *(["parts"] if "parts" in rows.columns else [])]
    return _by_conversation(rows.select(*names)).mapInPandas(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")
