"""The best products against scoring everything."""

import numpy as np
import pytest

from coursepulse.operators import best_products
from coursepulse.operators.recommend import RECS


def frame(spark, vectors, first=0):
    return spark.createDataFrame(
        [(first + n, [float(x) for x in v]) for n, v in enumerate(vectors)], "id int, features array<float>")


@pytest.mark.parametrize("n", [1, 5, 60])
@pytest.mark.parametrize("kind", ["uneven", "alike", "signs"])
def test_same_as_scoring_everything(spark, kind, n):
    rng = np.random.default_rng(7)
    items = rng.normal(size=(45, 6)) * (rng.gamma(0.5, 2, (45, 1)) if kind == "uneven" else 1)
    users = rng.normal(size=(70, 6))
    if kind == "signs":
        items, users = np.sign(items), np.sign(users)  # many ties
    items, users = items.astype(np.float32), users.astype(np.float32)
    rows = best_products.best_products(
        frame(spark, users), frame(spark, items, 100).repartition(3), n, "u", "i").collect()
    assert len(rows) == 70
    scores = users.astype(float) @ items.astype(float).T
    for row in rows:
        want = sorted(((-s, 100 + i) for i, s in enumerate(scores[row.u])))[:n]
        assert [r.i for r in row[RECS]] == [i for _, i in want]
        assert np.allclose([r.rating for r in row[RECS]], [-s for s, _ in want], rtol=1e-6)
        assert row.scored <= 45
    if kind == "uneven" and n == 1:
        assert sum(row.scored for row in rows) < 70 * 45 / 2


def test_empty_tables_and_sizes(spark, monkeypatch):
    users, items = frame(spark, [[1, 2], [0, 0]]), frame(spark, [[1, 1], [2, 2]])
    none = users.limit(0)
    assert best_products.best_products(none, items, 2, "u", "i").count() == 0
    assert [r[RECS] for r in best_products.best_products(users, none, 2, "u", "i").collect()] == [[], []]
    zero = best_products.best_products(users, items, 2, "u", "i").collect()[1]
    assert [(r.i, r.rating) for r in zero[RECS]] == [(0, 0.0), (1, 0.0)]
    monkeypatch.setattr(best_products, "MOST_SENT", 3)
    with pytest.raises(ValueError):
        best_products.best_products(users, items, 2, "u", "i")
