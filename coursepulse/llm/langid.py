"""Language identification as a mixture of languages.

Each language has a distribution over hashed letter trigrams, counted over all labelled documents. A
document's trigrams are drawn from a mixture of languages; expectation maximisation estimates the
proportions, until these stand still. The set of its languages then grows by the next likely one as
long as the likelihood, less a penalty for each language (the Bayesian information criterion), gets
better. The language of the largest proportion in that set is the prediction, the proportion its score.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.text import id_fold, runs_of

UNKNOWN = "und"
BUCKETS = 8192
_ROWS = 128  # documents per block of counts
#: Proportions stand still when none moves by more in a step; the steps are bounded for ties only.
_TOLERANCE, _MOST_STEPS = 2e-3, 500


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams per bucket, one row per text, and whether the text has a letter. A trigram has a
    letter in the middle; whatever isn't a letter counts as the same gap."""
    lowered = [text.lower() + "\n" for text in texts]
    lengths = np.array([len(text) for text in lowered])
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    owner = np.repeat(np.arange(len(texts)), lengths)
    worded = np.bincount(owner, letter, len(texts)) > 0
    at = np.flatnonzero(letter)
    codes = np.where(letter, codes, 32).astype(np.uint32)
    before = np.where(at > 0, codes[at - 1], 32).astype(np.uint32)
    hashed = (before * np.uint32(0x9E3779B1)) ^ (codes[at] * np.uint32(0x85EBCA77))
    hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
    hashed = (hashed ^ codes[at + 1]) * np.uint32(0x27D4EB2F)
    bucket = (hashed >> np.uint32(19)).astype(np.int64)
    counts = np.bincount(owner[at] * BUCKETS + bucket, minlength=len(texts) * BUCKETS)
    return counts.reshape(len(texts), BUCKETS), worded


def _blocks(texts) -> Iterator[list[str]]:
    for run in runs_of(texts):
        for start in range(0, len(run), _ROWS):
            yield run[start : start + _ROWS]


@dataclass(frozen=True)
class Languages:
    """Names, and the probability of each trigram bucket in each language."""

    names: list[str]
    chances: np.ndarray

    def proportions(self, counts: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated mixtures from ``start`` (languages at zero stay out), and log likelihoods."""
        mixed = start.copy()
        moving, part = np.arange(len(counts)), counts
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        for _ in range(_MOST_STEPS):
            before = mixed[moving]
            weight = part / np.maximum(before @ self.chances, 1e-30)
            now = before * (weight @ self.chances.T) / total[moving]
            now /= np.maximum(now.sum(axis=1, keepdims=True), 1e-30)
            mixed[moving] = now
            still = np.abs(now - before).max(axis=1) <= _TOLERANCE
            if still.any():
                moving = moving[~still]
                if not len(moving):
                    break
                part = counts[moving]
        return mixed, (counts * np.log(np.maximum(mixed @ self.chances, 1e-30))).sum(axis=1)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not texts:
            return [], np.empty(0)
        counts, worded = trigram_counts(texts)
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        counts = counts.astype(np.float32)
        counts = counts[:, (used := counts.any(axis=0))]
        seen = Languages(self.names, self.chances[:, used].astype(np.float32))
        number = len(self.names)
        rows = np.arange(len(texts))
        size = counts.sum(axis=1)
        even = np.full((len(texts), number), 1 / number, np.float32)
        full, _ = seen.proportions(counts, even)
        order = np.argsort(-full, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(number)[None, :], axis=1)
        penalty = 0.5 * np.log(np.maximum(size, 2))
        # a single language's likelihood needs no estimate; the best of them is the smallest set
        single = counts @ np.log(seen.chances).T
        best = single.argmax(axis=1)
        chosen, gain = np.zeros_like(full), single[rows, best] - penalty
        chosen[rows, best] = 1
        growing = rows
        for held in range(2, number + 1):
            start = np.where(place[growing] < held, np.maximum(full[growing], 1e-6), 0)
            mixed, fit = seen.proportions(
                counts[growing], (start / start.sum(1, keepdims=True)).astype(np.float32))
            worth = fit - held * penalty[growing]
            better = worth > gain[growing]
            growing = growing[better]
            if not len(growing):
                break
            chosen[growing], gain[growing] = mixed[better], worth[better]
        top = chosen.argmax(axis=1)
        names = [self.names[at] if has else UNKNOWN for at, has in zip(top, worded, strict=True)]
        return names, np.where(worded, np.clip(chosen[rows, top], 0, 1), 0.0)


def fit_languages(documents: DataFrame, folds: int = 4, test_fold: int = 2) -> Languages:
    """Trigram distributions counted over all documents outside the test fold that have an id, a
    language and a text. Repeated rows count each time."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, group in batch.groupby("lang"):
                held = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                for block in _blocks(group["text"]):
                    held += trigram_counts(block)[0].sum(axis=0)
        for name, held in totals.items():
            used = np.flatnonzero(held)
            yield pd.DataFrame({"lang": name, "bucket": used, "count": held[used]})

    rows = documents.select("text", "lang").filter(
        (id_fold("doc_id", folds) != test_fold) & F.col("lang").isNotNull()
        & F.col("text").isNotNull())
    # at most BUCKETS rows per language
    found = rows.mapInPandas(count, "lang string, bucket int, count long").groupBy(
        "lang", "bucket").agg(F.sum("count").alias("count")).collect()
    names = sorted({row["lang"] for row in found})
    counts = np.full((len(names), BUCKETS), 0.5)
    for row in found:
        counts[names.index(row["lang"]), row["bucket"]] += row["count"]
    return Languages(names, counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def language(known: Languages, text: str) -> Column:
    """``struct<lang, score>`` of a text column; ``und`` and 0 without a letter, for null, and
    where no language was learned."""
    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = [], []
            for block in _blocks(texts):
                found, score = known.predict(block)
                names += found
                scores.append(score)
            yield pd.DataFrame({
                "lang": pd.Series(names, dtype=object),
                "score": np.concatenate(scores).astype(float) if scores else np.empty(0)})

    return predict(F.col(text))
