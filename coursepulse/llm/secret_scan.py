"""Secrets in texts: fixed shapes, and strings of high entropy.

The fixed shapes are assignments of a value to a telling name, access key ids, and long hexadecimal
strings. The others are found by Shannon entropy. A candidate is a run of characters that keys are
written in. For each character class, a window slides over the candidate's runs of that class; the
counts of its characters and the sum they add up to are changed by the one that enters and the one that
leaves. Windows of at least the class's entropy make a span. What the allow list matches (words, plain
numbers, UUIDs, alphabets, placeholders) is cut out of the candidate before.

Sums are integers (``count * log2(count)`` in fixed point), so that a window's verdict doesn't depend
on how it was reached.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Span(NamedTuple):
    """A find, in code points of the whole text, its end exclusive."""

    start: int
    rank: int
    end: int
    kind: str


#: Kinds in the order in which spans of one start are listed.
ASSIGN, ACCESS, HEX, ENTROPY = KINDS = ("assign", "access", "hex", "entropy")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the same as whole runs of which short ones are dropped
LEAST_VALUE, LEAST_ACCESS = 6, 20


@dataclass(frozen=True)
class CharacterClass:
    """Characters (inside of a regular expression's brackets), and the entropy in bits per character
    from which on a window of so many of them is no ordinary text."""

    characters: str
    window: int
    bits: float


#: A window of 20 random characters has 3.4 bits in 16 letters, 3.8 in 36, and 4.0 in 62.
CLASSES = (
    CharacterClass("0-9a-fA-F", 20, 3.0),
    CharacterClass("A-Za-z0-9", 20, 3.6),
    CharacterClass("A-Za-z0-9+/_=-", 24, 4.0),
)

#: What isn't secret, as regular expressions; matched inside of candidates. They begin where a run
#: begins and don't go back, so that a long run is read once.
ALLOW = (
    r"(?<![A-Za-z0-9])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])(?:[A-Z]?[a-z]++)++(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])[A-Z]++(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])[0-9]++(?![A-Za-z0-9])",
    r"(?:0123456789)?ABCDEFGHIJKLMNOPQRSTUVWXYZ(?:abcdefghijklmnopqrstuvwxyz)?(?:0123456789)?",
    r"(?:0123456789)?abcdefghijklmnopqrstuvwxyz(?:ABCDEFGHIJKLMNOPQRSTUVWXYZ)?(?:0123456789)?",
    r"0123456789(?:abcdef|ABCDEF)",
    r"(?<![A-Za-z0-9])[A-Za-z0-9]*?"
    r"(?:EXAMPLE|example|PLACEHOLDER|placeholder|CHANGEME|changeme)[A-Za-z0-9]*+",
)

_ONE = 1 << 40


def fixed_entropy(count: int) -> int:
    """``count * log2(count)`` in fixed point; a window's entropy is log2 of its length less the sum of
    these over its characters, divided by its length."""
    return round(count * math.log2(count) * _ONE) if count > 1 else 0


def most_order(window: int, bits: float) -> int:
    """The largest sum of :func:`fixed_entropy` that a window of at least these bits has."""
    return math.floor(window * (math.log2(window) - bits) * _ONE)


def tangled(text: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Stretches of ``text`` covered by windows of at least ``bits`` per character, in order."""
    if len(text) < window:
        return
    worth = [fixed_entropy(count) for count in range(window + 1)]
    most, order, counts = most_order(window, bits), 0, {}
    start = end = -1
    for at, character in enumerate(text):
        count = counts.get(character, 0)
        counts[character] = count + 1
        order += worth[count + 1] - worth[count]
        low = at - window + 1
        if low < 0:
            continue
        if order <= most:
            if low > end:
                if end > 0:
                    yield start, end
                start = low
            end = at + 1
        gone = text[low]
        count = counts[gone]
        counts[gone] = count - 1
        order += worth[count - 1] - worth[count]
    if end > 0:
        yield start, end


class Scanner:
    """Finds secrets by the given classes and allow list."""

    def __init__(self, classes: Sequence[CharacterClass] = CLASSES, allow: Sequence[str] = ALLOW):
        self.classes = [(re.compile(f"[{c.characters}]{{{c.window},}}"), c) for c in classes]
        every = "|".join(f"[{c.characters}]" for c in classes)
        least = min((c.window for c in classes), default=1)
        self.candidate = re.compile(f"(?:{every}){{{least},}}") if classes else None
        self.allow = re.compile("|".join(f"(?:{one})" for one in allow)) if allow else None

    def spans(self, text: str | None) -> list[Span]:
        """All spans of a text, by start, then kind; none of a null."""
        if not text:
            return []
        fixed = sorted(self._fixed(text))
        return sorted([*fixed, *self._beside(fixed, self._entropy(text))])

    @staticmethod
    def _fixed(text: str) -> Iterator[Span]:
        for found in _ASSIGN.finditer(text):
            if found.end(2) - found.start(2) >= LEAST_VALUE:
                yield Span(found.start(), 0, found.end(), ASSIGN)
        for found in _ACCESS.finditer(text):
            if found.end() - found.start() >= LEAST_ACCESS:
                yield Span(found.start(), 1, found.end(), ACCESS)
        for found in _HEX.finditer(text):
            yield Span(found.start(), 2, found.end(), HEX)

    def _entropy(self, text: str) -> Iterator[Span]:
        """Merged stretches of all classes, in order."""
        if self.candidate is None:
            return
        for found in self.candidate.finditer(text):
            stretches = sorted(
                (found.start() + low + run.start() + start, found.start() + low + run.start() + end)
                for low, part in self._parts(found.group())
                for pattern, kind in self.classes
                for run in pattern.finditer(part)
                for start, end in tangled(run.group(), kind.window, kind.bits))
            start = end = -1
            for low, high in stretches:
                if low > end:
                    if end > 0:
                        yield Span(start, 3, end, ENTROPY)
                    start, end = low, high
                end = max(end, high)
            if end > 0:
                yield Span(start, 3, end, ENTROPY)

    def _parts(self, candidate: str) -> Iterator[tuple[int, str]]:
        """The candidate's stretches between what the allow list matches, with their starts."""
        last = 0
        for found in self.allow.finditer(candidate) if self.allow else ():
            yield last, candidate[last : found.start()]
            last = found.end()
        yield last, candidate[last:]

    @staticmethod
    def _beside(fixed: list[Span], entropy: Iterator[Span]) -> Iterator[Span]:
        """Spans of ``entropy``, in order, that no fixed one holds whole."""
        at, reach = 0, -1
        for span in entropy:
            while at < len(fixed) and fixed[at].start <= span.start:
                reach = max(reach, fixed[at].end)
                at += 1
            if reach < span.end:
                yield span


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def secret_spans(text: str, scanner: Scanner | None = None) -> Column:
    """The spans of the whole text in the column of this name."""
    scanner = scanner or Scanner()

    @F.pandas_udf(_SPANS)
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [{"kind": s.kind, "start": s.start, "end": s.end} for s in scanner.spans(one)]
            for one in texts])

    return find(F.col(text))


def find_secrets(documents: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """``doc_id, spans``: a row per row of ``documents``, of which ``doc_id`` and ``text`` are read.

    Map-only. A null text is empty, and an empty one has an empty list; a null id stays one; a repeated
    row is found in again. Other columns are ignored. A text's work grows with its length.
    """
    return documents.select("doc_id", secret_spans("text", scanner).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as text: ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_digests(documents: DataFrame) -> DataFrame:
    """Per document, what :func:`find_secrets` found: counts and digest of the fixed kinds, and all
    spans as text."""
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    fixed = F.filter(spans, lambda s: s["kind"] != ENTROPY)
    return find_secrets(documents).select(
        "doc_id", count(ASSIGN), count(ACCESS), count(HEX),
        F.sha2(listed(fixed).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"))
