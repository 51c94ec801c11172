"""Last write wins per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    rows: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """The latest row per key by ``order``; equal orders fall back to the other values.

    A max over one struct combines map-side, so a key with many versions shrinks to one row per
    input partition before the shuffle, and the winner does not depend on task order.
    """
    rest = [c for c in rows.columns if c not in key and c not in order]
    version = F.struct(*order, *rest)
    winners = rows.groupBy(*key).agg(F.max(version).alias("_latest"))
    picked = [c if c in key else F.col("_latest")[c].alias(c) for c in rows.columns]
    return winners.select(*picked)


def has_key(key: Sequence[str]):
    """True where every key column is present."""
    condition = F.lit(True)
    for name in key:
        condition = condition & F.col(name).isNotNull()
    return condition
