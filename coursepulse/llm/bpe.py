"""Byte-level BPE encoding and decoding with the ranks of a given vocabulary.

A text is cut by the vocabulary's pattern; each piece is merged on its own. Over the byte positions
of a piece lies a segment tree of the ranks of neighbouring pairs: its root is the leftmost pair of
the smallest rank, and a merge updates the two pairs beside it in logarithmic time, so that a piece
of n bytes takes n log n steps however long it is.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.text import runs_of

_NONE = 1 << 62
_PLACE = (1 << 32) - 1
#: Pieces of up to LONGEST + 1 bytes are merged side by side, if there are so many of a length.
LONGEST, FEWEST = 64, 8


class Vocabulary:
    """Ranks of byte strings, and the pattern that cuts texts into pieces."""

    #: Pieces whose tokens are remembered; forgotten all at once beyond that. A run of texts with
    #: more of them is still merged in one go.
    MOST_PIECES = 300_000

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.text_of = {rank: str(rank) for rank in ranks.values()}
        self.single = np.array([ranks.get(bytes([byte]), -1) for byte in range(256)])
        self.pairs = np.array([ranks.get(bytes(divmod(pair, 256)), -1) for pair in range(1 << 16)])
        # every way in which two tokens make a third
        joints = sorted(
            (ranks[token[:at]] << 32 | ranks[token[at:]], rank) for token, rank in ranks.items()
            for at in range(1, len(token)) if token[:at] in ranks and token[at:] in ranks)
        self.joints, self.joint_ranks = np.array(joints or [(-1, -1)], dtype=np.int64).T.copy()
        self.cut = regex.compile(pattern).findall
        self.memory: dict[str, tuple[int, str, bytes]] = {}

    @classmethod
    def parse(cls, lines: bytes, pattern: str) -> Vocabulary:
        """From lines of a base64 token and its rank."""
        pairs = (line.split() for line in lines.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def merge(self, piece: bytes) -> list[int]:
        """The tokens of one piece."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        size = 1 << max(n - 2, 0).bit_length()  # leaves, one per pair of neighbours
        tree = [_NONE] * (2 * size)
        for at in range(n - 1):
            rank = ranks.get(piece[at : at + 2])
            if rank is not None:
                tree[size + at] = rank << 32 | at
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        stop = list(range(1, n + 1))  # where the token that starts here ends
        before = list(range(-1, n))  # where the token before the one that starts here starts

        def put(leaf: int, key: int) -> None:
            node = size + leaf
            tree[node] = key
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                if other < key:
                    key = other
                if tree[node] == key:
                    return
                tree[node] = key

        while tree[1] != _NONE:
            at = tree[1] & _PLACE
            joined = stop[at]
            end = stop[at] = stop[joined]
            before[end] = at
            if joined < n - 1:
                put(joined, _NONE)
            rank = ranks.get(piece[at : stop[end]]) if end < n else None
            put(at, _NONE if rank is None else rank << 32 | at)
            left = before[at]
            if left >= 0:
                rank = ranks.get(piece[left:end])
                put(left, _NONE if rank is None else rank << 32 | left)
        tokens, at = [], 0
        while at < n:
            tokens.append(ranks[piece[at : stop[at]]])
            at = stop[at]
        return tokens

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """The tokens of many pieces; short ones of like length are merged side by side."""
        found: list[list[int]] = [[]] * len(pieces)
        alike: dict[int, list[int]] = {}
        for number, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[number] = [whole]
            else:
                alike.setdefault(1 << max(len(piece) - 2, 0).bit_length(), []).append(number)
        for size, numbers in alike.items():
            given = [pieces[number] for number in numbers]
            if size > LONGEST or len(given) < FEWEST:
                merged = map(self.merge, given)
            else:
                merged = self._merge_side_by_side(size, given)
            for number, tokens in zip(numbers, merged, strict=True):
                found[number] = tokens
        return found

    def _merge_side_by_side(self, size: int, pieces: list[bytes]) -> list[list[int]]:
        """:meth:`merge` for pieces of at most ``size`` + 1 bytes, a tree in each row of an array and
        a merge in each row a turn."""
        width, number = size + 1, len(pieces)
        length = np.array([len(piece) for piece in pieces])
        raw = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces),
                            np.uint8).reshape(number, width).astype(np.int64)
        place = np.arange(size)
        rank = self.pairs[raw[:, :-1] << 8 | raw[:, 1:]]
        tree = np.full((number, 2 * size), _NONE)
        tree[:, size:] = np.where(
            (rank >= 0) & (place < length[:, None] - 1), rank << 32 | place, _NONE)
        level = size // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(
                tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        token = self.single[raw]
        live = np.arange(width) < length[:, None]
        stop = np.tile(np.arange(1, width + 1), (number, 1))
        before = np.tile(np.arange(-1, width), (number, 1))
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            least = tree[rows, 1]
            at, merged = least & _PLACE, least >> 32
            joined = stop[rows, at]
            end = stop[rows, joined]
            token[rows, at] = merged
            live[rows, joined] = False
            stop[rows, at] = end
            before[rows, end] = at
            left = before[rows, at]
            rank = self._rank(merged, token[rows, np.minimum(end, width - 1)])
            key = np.where((rank >= 0) & (end < length[rows]), rank << 32 | at, _NONE)
            # the second half starts no pair any more; where it had no leaf, this one's is set twice
            gone = np.where(joined < size, joined, at)
            tree[rows, size + gone] = _NONE
            tree[rows, size + at] = key
            rank = self._rank(token[rows, np.maximum(left, 0)], merged)
            has = left >= 0
            tree[rows[has], size + left[has]] = np.where(
                rank >= 0, rank << 32 | left, _NONE)[has]
            nodes = size + np.stack([at, gone, np.where(has, left, at)])
            for _ in range(size.bit_length() - 1):
                nodes >>= 1
                tree[rows, nodes] = np.minimum(tree[rows, 2 * nodes], tree[rows, 2 * nodes + 1])
            rows = rows[tree[rows, 1] != _NONE]
        flat, cuts = token[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
        return [flat[low:high] for low, high in zip([0, *cuts], cuts)]

    def _rank(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that two tokens make together, -1 where they make none."""
        key = first << 32 | second
        at = np.searchsorted(self.joints, key)
        at[at == len(self.joints)] = 0
        return np.where(self.joints[at] == key, self.joint_ranks[at], -1)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of some tokens; an unknown id is an error."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def pieces(self, texts: Iterable[str | None]) -> Iterator[list[tuple[int, str, bytes]]]:
        """For each text its pieces: the number of tokens, their ids as text, and the bytes that they
        decode to. Pieces not remembered are merged together for a run of texts."""
        memory = self.memory
        for run in runs_of(texts):
            cut = [self.cut(text) for text in run]
            new = {piece for pieces in cut for piece in pieces if piece not in memory}
            if len(memory) + len(new) > self.MOST_PIECES:
                memory.clear()
                new = {piece for pieces in cut for piece in pieces}
            new = list(new)
            for piece, ids in zip(new, self.merge_all([p.encode() for p in new]), strict=True):
                text = ",".join(map(self.text_of.__getitem__, ids))
                memory[piece] = len(ids), text, self.decode(ids)
            for pieces in cut:
                yield [memory[piece] for piece in pieces]

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        for pieces in self.pieces(texts):
            yield [int(i) for piece in pieces for i in piece[1].split(",")]


@functools.lru_cache(maxsize=4)
def _vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    """One vocabulary per Python worker, kept between tasks."""
    return Vocabulary.parse(lines, pattern)


def _read(path: str) -> bytes:
    # below a megabyte; travels with the function, so executors need no copy of the file
    with open(path, "rb") as file:
        return file.read()


def encode(text: str, vocabulary: str, pattern: str) -> Column:
    """Token ids of a text column by the vocabulary file at ``vocabulary``; null is empty."""
    lines = _read(vocabulary)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        encoder = _vocabulary(lines, pattern)
        return pd.Series(list(encoder.encode_all(texts)), dtype=object)

    return ids(F.col(text))


def decode(ids: str, vocabulary: str, pattern: str) -> Column:
    """The bytes of an id column; null has none."""
    lines = _read(vocabulary)

    @F.pandas_udf("binary")
    def decoded(lists: pd.Series) -> pd.Series:
        decoder = _vocabulary(lines, pattern)
        return pd.Series([b"" if value is None else decoder.decode(value) for value in lists],
                         dtype=object)

    return decoded(F.col(ids))


def round_trip_digests(documents: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row's whole text.

    Null texts are empty. Rows with the same id, or without one, each give a row. Other columns are
    not read.
    """
    lines = _read(vocabulary)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _vocabulary(lines, pattern)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for pieces in coder.pieces(batch["text"]):
                counts.append(sum(map(itemgetter(0), pieces)))
                joined = ",".join(map(itemgetter(1), pieces))
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(itemgetter(2), pieces))).hexdigest())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_tokens": counts,
                                "ids_sha256": ids, "decoded_sha256": decoded})
        coder.memory.clear()  # the worker may go on to other work

    return documents.select("doc_id", "text").mapInPandas(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
