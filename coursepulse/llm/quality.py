"""Quality: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` characters. Each passage is encoded by its make-up
(shares of character classes, of the pairs of neighbouring classes, and of what the document has
said before). Only documents carry labels: gated attention, ``softmax(w . (tanh(V h) * sigmoid(U h)))``
over the passages of a document, learns which passages decide, and the label is predicted from the
attention-weighted mean of the encoded passages.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.fitting import fit_in_task, labelled_sample
from coursepulse.llm.text import mix, runs_of

THRESHOLD = 0.7
SAMPLE_ROWS = 6_000
PASSAGE = 500
#: Classes: lower case and caseless letters, upper case, digits, spaces, line ends, sentence
#: marks, quotes and brackets, other marks, anything else.
CLASSES = 9
REPEAT_RUN = 12
FEATURES = CLASSES + CLASSES * CLASSES + 5


@functools.cache
def class_table() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, 8, dtype=np.uint8)
    for code in range(0x30000):
        kind = unicodedata.category(chr(code))
        if kind == "Lu":
            table[code] = 1
        elif kind[0] == "L" or kind[0] == "M":
            table[code] = 0
        elif kind[0] == "N":
            table[code] = 2
        elif kind[0] == "Z":
            table[code] = 3
        elif kind in ("Ps", "Pe", "Pi", "Pf"):
            table[code] = 6
        elif kind[0] in "PS":
            table[code] = 7
    table[[9, 32]] = 3
    table[[10, 13]] = 4
    table[[ord(c) for c in ".,;:?-"]] = 5
    table[[ord(c) for c in "'\""]] = 6
    return table


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages of some texts, and the passages' text numbers; an empty text is one passage
    of zeros."""
    lengths = np.array([len(text) for text in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    pieces = np.maximum(1, (lengths + PASSAGE // 2) // PASSAGE)  # a short rest joins the last
    owner = np.repeat(np.arange(len(texts)), pieces)
    first = np.cumsum(pieces) - pieces
    nth = np.arange(len(owner)) - first[owner]
    begin = starts[owner] + nth * PASSAGE
    until = np.where(nth == pieces[owner] - 1, ends[owner], begin + PASSAGE)
    size = np.maximum(until - begin, 1).astype(float)
    number = len(owner)
    if not len(codes):
        return np.zeros((number, FEATURES)), owner
    passage = np.repeat(np.arange(number), until - begin)
    kind = class_table()[codes].astype(np.int64)
    single = np.bincount(passage * CLASSES + kind, minlength=number * CLASSES)
    single = single.reshape(number, CLASSES) / size[:, None]
    pair = kind[:-1] * CLASSES + kind[1:]
    inside = passage[:-1] == passage[1:]
    both = np.bincount(passage[:-1][inside] * CLASSES ** 2 + pair[inside],
                       minlength=number * CLASSES ** 2).reshape(number, -1) / size[:, None]
    more = np.zeros((number, 5))
    repeated, runs = _repeats(codes, passage, owner, number)
    more[:, 0] = repeated
    more[:, 1] = runs
    spaces = np.maximum((single[:, 3] + single[:, 4]) * size, 1)
    held = until - begin
    more[:, 2] = np.minimum(held / spaces, 40) / 10  # characters a word
    more[:, 3] = np.minimum(held / PASSAGE, 1)
    letters = np.maximum(single[:, 0] + single[:, 1], 1e-3)
    more[:, 4] = single[:, 1] / letters
    return np.hstack([np.sqrt(single), np.sqrt(both), more]), owner


def _repeats(codes, passage, owner, number):
    """For each passage: the share of its runs of characters that its document had before, and
    whether it has runs."""
    if len(codes) < REPEAT_RUN:
        return np.zeros(number), np.zeros(number)
    hashed = codes[: len(codes) - REPEAT_RUN + 1].astype(np.uint64)
    for step in range(1, REPEAT_RUN):
        hashed = hashed * np.uint64(0x100000001B3)
        hashed += codes[step : len(codes) - REPEAT_RUN + 1 + step]
    hashed = mix(hashed)
    document = owner[passage]
    at = np.flatnonzero(document[: len(hashed)] == document[REPEAT_RUN - 1 :])
    key = hashed[at] ^ mix(document[at].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(at), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    total = np.bincount(passage[at], minlength=number)
    share = np.bincount(passage[at][again], minlength=number) / np.maximum(total, 1)
    return share, (total > 0).astype(float)


@dataclass(frozen=True)
class Attention:
    """The fitted network; ``parts`` holds its arrays by name."""

    centre: np.ndarray
    spread: np.ndarray
    parts: dict

    def bags(self, features: np.ndarray, owner: np.ndarray, bags: int):
        """What each layer gives, for scoring and for fitting."""
        p = self.parts
        x = np.clip((features - self.centre) / self.spread, -6, 6)
        hidden = np.tanh(x @ p["A"] + p["a"])
        tanh, gate = np.tanh(hidden @ p["V"]), 1 / (1 + np.exp(-(hidden @ p["U"])))
        weight = (tanh * gate) @ p["w"]
        top = np.full(bags, -np.inf)
        np.maximum.at(top, owner, weight)
        weight = np.exp(weight - top[owner])
        weight /= np.bincount(owner, weight, bags)[owner]
        pooled = np.stack([np.bincount(owner, weight * hidden[:, j], bags)
                           for j in range(hidden.shape[1])], 1)
        raw = np.clip(pooled @ p["c"] + p["b"], -30, 30)
        return x, hidden, tanh, gate, weight, pooled, 1 / (1 + np.exp(-raw))

    def score(self, texts: list[str]) -> np.ndarray:
        features, owner = encode(texts)
        return self.bags(features, owner, len(texts))[-1]


def _constant(score: float) -> Attention:
    width = 1
    zeros = {"A": np.zeros((FEATURES, width)), "a": np.zeros(width), "V": np.zeros((width, 1)),
             "U": np.zeros((width, 1)), "w": np.zeros(1), "c": np.zeros(width),
             "b": np.array(30.0 if score > 0.5 else -30.0)}
    return Attention(np.zeros(FEATURES), np.ones(FEATURES), zeros)


def fit_attention(texts: Sequence[str], labels: np.ndarray, width: int = 16, gates: int = 8,
                  epochs: int = 40, batch: int = 64, step: float = 0.01, decay: float = 1e-4,
                  seed: int = 11) -> Attention:
    """Adam on the cross entropy of the documents' labels, both classes of about equal weight.

    With one class only, every text gets that class.
    """
    if not len(labels) or labels.min() == labels.max():
        return _constant(float(labels[0]) if len(labels) else 1.0)
    encoded = [encode(part) for part in runs_of(texts)]
    features = np.vstack([found for found, _ in encoded])
    sizes = np.concatenate([np.bincount(owner) for _, owner in encoded])
    last = np.cumsum(sizes)
    rng = np.random.default_rng(seed)
    parts = {
        "A": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, width)), "a": np.zeros(width),
        "V": rng.normal(0, 0.5, (width, gates)), "U": rng.normal(0, 0.5, (width, gates)),
        "w": rng.normal(0, 0.5, gates), "c": rng.normal(0, 0.3, width), "b": np.array(0.0),
    }
    net = Attention(features.mean(0), np.maximum(features.std(0), 0.02), parts)
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    share = labels.mean()
    cost = np.where(labels == 1, min(1.0, (1 - share) / share * 2), min(1.0, share / (1 - share) * 2))
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            rows = np.concatenate([np.arange(last[i] - sizes[i], last[i]) for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes[chosen])
            x, hidden, tanh, gate, weight, pooled, score = net.bags(features[rows], owner, len(chosen))
            miss = (score - labels[chosen]) * cost[chosen] / len(chosen)
            d_pooled = miss[:, None] * parts["c"]
            d_hidden = weight[:, None] * d_pooled[owner]
            d_weight = (hidden * d_pooled[owner]).sum(1)
            d_raw = weight * (d_weight - np.bincount(owner, weight * d_weight, len(chosen))[owner])
            d_gated = d_raw[:, None] * parts["w"]
            d_tanh, d_gate = d_gated * gate * (1 - tanh ** 2), d_gated * tanh * gate * (1 - gate)
            d_hidden += d_tanh @ parts["V"].T + d_gate @ parts["U"].T
            d_in = d_hidden * (1 - hidden ** 2)
            grads = {"A": x.T @ d_in, "a": d_in.sum(0), "V": hidden.T @ d_tanh,
                     "U": hidden.T @ d_gate, "w": (tanh * gate).T @ d_raw, "c": pooled.T @ miss,
                     "b": miss.sum()}
            done += 1
            for name, grad in grads.items():
                grad = grad + decay * parts[name]
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad ** 2
                parts[name] -= step * (first[name] / (1 - 0.9 ** done)) / (
                    np.sqrt(second[name] / (1 - 0.999 ** done)) + 1e-8)
    return net


def fit_quality(documents: DataFrame, labels: DataFrame, folds: int = 4, test_fold: int = 2,
                most_rows: int = SAMPLE_ROWS) -> Attention:
    """A network fitted on at most ``most_rows`` labelled documents outside the test fold.

    Without any labelled row every text counts as good.
    """
    rows = labelled_sample(documents, labels, "quality", folds, test_fold, most_rows)

    def fit(group: pd.DataFrame) -> Attention:
        group = group.sort_values("doc_id", kind="stable")
        texts = [text if isinstance(text, str) else "" for text in group["text"]]
        return fit_attention(texts, group["label"].to_numpy())

    return fit_in_task(rows, fit) or _constant(1.0)


def quality_score(net: Attention, text: str) -> Column:
    """The score of a text column, 0 to 1. Null counts as empty, and an empty text is scored as
    one passage without any character."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [net.score(part) for part in runs_of(texts)]
            yield pd.Series(np.concatenate(found) if found else [], dtype="float64")

    return score(F.col(text))


def reject_low_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that reach the threshold, all columns and repeated rows as they are."""
    return documents.filter(quality_score(fit_quality(documents, labels), "text") >= THRESHOLD)
