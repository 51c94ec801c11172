"""Words, shingles and hashes shared by the text operators."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

SHINGLE_WORDS = 5

_WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x2545F4914F6CDD1D)


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return _WORD.findall(text.lower()) if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the finalizer of splitmix64)."""
    z = values + _STEP
    z = (z ^ (z >> np.uint64(30))) * _MIX_1
    z = (z ^ (z >> np.uint64(27))) * _MIX_2
    return z ^ (z >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``size`` words.

    A text of fewer words has one shingle, all of its words; a text without words has none.
    """
    found = words(text)
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, n)
    size = min(size, n)
    runs = hashed[: n - size + 1].copy()
    for step in range(1, size):
        runs *= _BASE
        runs += hashed[step : n - size + 1 + step]
    return np.unique(mix(runs + np.uint64(size)))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The number of values that two sorted distinct arrays share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


def runs_of(texts: Sequence[str], most_chars: int = 300_000) -> Iterator[list[str]]:
    """Consecutive texts in lists of about ``most_chars`` characters, for array work in bounded
    memory. A longer text is a list of its own; null counts as empty."""
    batch, chars = [], 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if batch and chars + len(text) > most_chars:
            yield batch
            batch, chars = [], 0
        batch.append(text)
        chars += len(text)
    if batch:
        yield batch


def id_fold(id_column: str, folds: int) -> Column:
    """The fold of a row: crc32 of the id as text, modulo ``folds``; null without an id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def held_out(id_column: str, folds: int, fold: int) -> Column:
    return F.coalesce(id_fold(id_column, folds) == fold, F.lit(False))


def only(rows: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that others can't clash with what an operator adds."""
    return rows.select(*names)
