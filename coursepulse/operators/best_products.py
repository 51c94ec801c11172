"""The n best courses of each student without scoring every pair.

A rating is the product of two vectors, and no larger than the product of their lengths. So courses are
scored in the order of their vectors' lengths, and a student is done once the next course's length, times
the student's own, doesn't reach the n-th best rating so far. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers in the courses' vectors that are sent to every task, 8 bytes each.
MOST_SENT = 16_000_000
#: Courses scored at once; after each run the students that are done are left out.
RUN = 8


def best_products(users: DataFrame, items: DataFrame, n: int, user: str, item: str) -> DataFrame:
    """``user, recommendations, scored``: the ``n`` best of ``items`` (``id, features``) for each of
    ``users`` (``id, features``), best first and equal ones by id, as an array of (``item``, ``rating``),
    and how many were scored for it.

    Map-only over the users; a task holds one batch of them. The items are sent to every task: more
    numbers than ``MOST_SENT`` in their vectors are an error, for which MLlib's blocked
    ``recommendForAllUsers`` is the way.
    """
    size = items.agg(F.sum(F.size("features"))).first()[0] or 0
    if size > MOST_SENT:
        raise ValueError(f"{size} numbers are too many to send to every task")
    table = items.select("id", "features").toArrow()
    ids = table["id"].to_numpy()
    vectors = _matrix(table["features"].to_pylist())
    lengths = np.linalg.norm(vectors, axis=1)
    order = np.lexsort((ids, -lengths))
    ids, vectors, lengths = ids[order], vectors[order], lengths[order]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = _matrix(batch["features"].to_pylist())
            best, ratings, scored = _search(given, vectors, lengths, ids, n)
            rows = [[{item: int(ids[at]), "rating": rating} for at, rating in zip(*row) if at >= 0]
                    for row in zip(best.tolist(), ratings.astype(np.float32).tolist())]
            yield pa.record_batch([batch["id"], pa.array(rows, _recommended(item)),
                                   pa.array(scored)], names=[user, "recommendations", "scored"])

    return users.select("id", "features").mapInArrow(
        search, f"{user} int, recommendations array<struct<{item}: int, rating: float>>, scored long")


def _matrix(rows: list[list[float]]) -> np.ndarray:
    return np.array(rows, float).reshape(len(rows), len(rows[0]) if rows else 0)


def _recommended(item: str) -> pa.DataType:
    return pa.list_(pa.struct([(item, pa.int32()), ("rating", pa.float32())]))


def _search(users, items, lengths, ids, n):
    """Places of the n best items per user (-1 where there are fewer), their ratings, and how many were
    scored. ``items`` are the longest first."""
    best = np.full((len(users), n), -1)
    ratings = np.full((len(users), n), -np.inf)
    scored = np.zeros(len(users), np.int64)
    own = np.linalg.norm(users, axis=1) * (1 + 1e-9)  # a bound that rounding doesn't break
    open_ = np.arange(len(users))
    for low in range(0, len(items), RUN):
        open_ = open_[own[open_] * lengths[low] >= ratings[open_, -1]]
        if not len(open_):
            break
        run = np.arange(low, min(low + RUN, len(items)))
        found = np.concatenate([ratings[open_], users[open_] @ items[run].T], axis=1)
        places = np.concatenate([best[open_], np.broadcast_to(run, (len(open_), len(run)))], axis=1)
        rank = np.lexsort((np.where(places >= 0, ids[places], 0), -found), axis=1)[:, :n]
        best[open_] = np.take_along_axis(places, rank, 1)
        ratings[open_] = np.take_along_axis(found, rank, 1)
        scored[open_] += len(run)
    return best, ratings, scored
