"""Toxicity: a factorization machine over hashed terms.

A document is the set of its terms: its distinct words and their beginnings of four and five
letters, which stand in for the inflected forms of a stem. Each term is hashed to 32 bits. The score
is ``sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>)``: the second sum learns pairs such as an insult
with the mention of a group, which a sum of weights alone cannot tell from either of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from coursepulse.llm.fitting import fit_in_task, labelled_sample
from coursepulse.llm.text import words

THRESHOLD = 0.7
SAMPLE_ROWS = 12_000
#: Length of a term's factors below which they are as they were when the fit began.
LEAST_FACTORS = 0.1


@dataclass(frozen=True)
class Machine:
    """Terms with a weight, in the order of their hashes."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def slots(self, hashed: np.ndarray) -> np.ndarray:
        """Positions of the known terms among ``hashed``."""
        if not len(self.terms):
            return np.empty(0, np.int64)
        at = np.searchsorted(self.terms, hashed)
        at[at == len(self.terms)] = 0
        return at[self.terms[at] == hashed]

    def score(self, slots: np.ndarray) -> float:
        picked = self.factors[slots]
        total = picked.sum(axis=0)
        raw = self.bias + self.weights[slots].sum() + 0.5 * float(
            (total * total).sum() - (picked * picked).sum())
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def word_terms(word: str) -> list[int]:
    found = [xxh32_intdigest(word)]
    if len(word) > 4:
        found.append(xxh32_intdigest(word[:4], 4))
    if len(word) > 5:
        found.append(xxh32_intdigest(word[:5], 5))
    return found


def document_terms(text: str | None) -> np.ndarray:
    """Distinct term hashes of a text, sorted."""
    found = [term for word in set(words(text)) for term in word_terms(word)]
    return np.unique(np.array(found, dtype=np.uint32))


def fit_machine(documents: list[np.ndarray], labels: np.ndarray, rank: int = 4, epochs: int = 40,
                least_documents: int = 3, least_chi2: float = 16.0, most_paired: int = 1024,
                least_pair_chi2: float = 40.0, l1: float = 5e-5, l2: float = 2e-3,
                step: float = 0.15, batch: int = 128, seed: int = 7) -> Machine:
    """Adaptive minibatch gradient descent with soft thresholds on the weights.

    Terms in fewer than ``least_documents`` documents, and those whose presence says nothing about
    the class by the chi-square statistic, are left out: most words of a language would only add
    noise that grows with a text's length. Of the ``most_paired`` most frequent terms, those stay too
    that say something in a pair, see :func:`_paired`. With one class only, the machine knows no term and
    scores every text with that class.
    """
    empty = np.empty(0, np.uint32)
    if not len(labels) or labels.min() == labels.max():
        bias = 30.0 if len(labels) and labels[0] else -30.0
        return Machine(bias, empty, empty.astype(float), np.empty((0, rank)))
    every, counts = np.unique(np.concatenate(documents), return_counts=True)
    toxic, number = float(labels.sum()), len(labels)
    hits = np.zeros(len(every))
    for found, label in zip(documents, labels, strict=True):
        if label:
            hits[np.searchsorted(every, found)] += 1
    apart = hits * number - counts * toxic
    chi2 = apart ** 2 * number / (counts * np.maximum(number - counts, 1e-9) * toxic
                                  * (number - toxic))
    telling = (counts >= least_documents) & (chi2 >= least_chi2)
    frequent = np.sort(np.argsort(-counts, kind="stable")[:most_paired])
    telling[frequent[_paired(documents, labels, every[frequent], least_pair_chi2)]] = True
    terms = every[telling]
    known = Machine(0.0, terms, empty, empty)
    slots = [known.slots(found) for found in documents]
    rng = np.random.default_rng(seed)
    size = len(terms)
    weights, factors = np.zeros(size), rng.normal(0, 0.02, (size, rank))
    seen_w, seen_f, bias, seen_b = np.full(size, 1e-6), np.full((size, rank), 1e-6), 0.0, 1e-6
    share = labels.mean()
    # both classes weigh the same in total, within a factor of four
    positive = min(4.0, (1 - share) / share)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            lengths = np.array([len(slots[i]) for i in chosen])
            flat = np.concatenate([slots[i] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), lengths)
            picked = factors[flat]
            total = np.stack([np.bincount(row, picked[:, f], len(chosen)) for f in range(rank)], 1)
            raw = bias + np.bincount(row, weights[flat], len(chosen)) + 0.5 * (
                (total * total).sum(1) - np.bincount(row, (picked * picked).sum(1), len(chosen)))
            miss = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]
            miss *= np.where(labels[chosen] == 1, positive, 1.0) / len(chosen)
            grad_b = miss.sum()
            seen_b += grad_b ** 2
            bias -= step * grad_b / np.sqrt(seen_b)
            if not len(flat):
                continue
            grad_w = np.bincount(flat, miss[row], size)
            used = np.flatnonzero(np.bincount(flat, minlength=size))
            seen_w[used] += grad_w[used] ** 2
            rate = step / np.sqrt(seen_w[used])
            moved = weights[used] - rate * grad_w[used]
            weights[used] = np.sign(moved) * np.maximum(np.abs(moved) - rate * l1, 0)
            pull = miss[row][:, None] * (total[row] - picked)
            grad_f = np.stack([np.bincount(flat, pull[:, f], size) for f in range(rank)], 1)[used]
            grad_f += l2 * factors[used]
            seen_f[used] += grad_f ** 2
            factors[used] -= 0.2 * step * grad_f / np.sqrt(seen_f[used])
    # a term without weight of its own, and with hardly any factors, only adds noise
    kept = (weights != 0) | (np.linalg.norm(factors, axis=1) > LEAST_FACTORS)
    return Machine(float(bias), terms[kept], weights[kept], factors[kept])


def _paired(documents: list[np.ndarray], labels: np.ndarray, terms: np.ndarray,
            least_chi2: float) -> np.ndarray:
    """Which terms change what another one says of the class, and the other way round: the smaller of
    the two chi-square statistics of a pair, each over the documents with one of its terms, has to
    reach ``least_chi2``. So a frequent word doesn't count for standing beside a toxic one."""
    held = np.zeros((len(documents), len(terms)), np.float32)
    for row, found in enumerate(documents):
        at = np.searchsorted(terms, found)
        at[at == len(terms)] = 0
        held[row, at[terms[at] == found]] = 1
    toxic = held[labels == 1]
    both, both_toxic = (held.T @ held).astype(float), (toxic.T @ toxic).astype(float)
    count, hits = np.diag(both)[:, None], np.diag(both_toxic)[:, None]
    spread = both * (count - both) * hits * (count - hits)
    given = (both_toxic * count - both * hits) ** 2 * count / np.maximum(spread, 1e-9)
    given[spread <= 0] = 0
    return (np.minimum(given, given.T) >= least_chi2).any(axis=1)


def fit_toxicity(documents: DataFrame, labels: DataFrame, folds: int = 3, test_fold: int = 1,
                 most_rows: int = SAMPLE_ROWS) -> Machine:
    """A machine fitted on at most ``most_rows`` labelled documents outside the test fold.

    Without any labelled row nothing counts as toxic.
    """
    rows = labelled_sample(documents, labels, "toxic", folds, test_fold, most_rows)

    @F.pandas_udf("array<long>")
    def terms_of(texts: pd.Series) -> pd.Series:
        return pd.Series([document_terms(text).astype(np.int64) for text in texts])

    def fit(group: pd.DataFrame) -> Machine:
        group = group.sort_values("doc_id", kind="stable")
        found = [np.asarray(terms, dtype=np.uint32) for terms in group["terms"]]
        return fit_machine(found, group["label"].to_numpy())

    fitted = fit_in_task(rows.select("doc_id", "label", terms_of("text").alias("terms")), fit)
    return fitted or fit_machine([], np.empty(0))


class Scorer:
    """Scores texts; remembers the slots of words, up to a bound."""

    MOST_WORDS = 200_000

    def __init__(self, machine: Machine):
        self.machine = machine
        self.memory: dict[str, tuple[int, ...]] = {}

    def _slots(self, word: str) -> tuple[int, ...]:
        found = self.machine.slots(np.array(word_terms(word), dtype=np.uint32))
        slots = tuple(found.tolist())
        if len(self.memory) >= self.MOST_WORDS:
            self.memory.clear()
        self.memory[word] = slots
        return slots

    def __call__(self, text: str | None) -> float:
        memory, found = self.memory, set()
        for word in set(words(text)):
            slots = memory.get(word)
            if slots is None:
                slots = self._slots(word)
            if slots:
                found.update(slots)
        return self.machine.score(np.array(sorted(found), dtype=np.int64))


def toxicity_score(machine: Machine, text: str) -> Column:
    """The score of a text column, 0 to 1; null and empty texts have the score of no term."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(machine)
        for texts in batches:
            yield pd.Series([scorer(value) for value in texts], dtype="float64")

    return score(F.col(text))


def reject_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that don't reach the threshold, all columns and repeated rows as they are."""
    return documents.filter(toxicity_score(fit_toxicity(documents, labels), "text") < THRESHOLD)
