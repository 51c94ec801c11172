"""Course popularity from sketches that add up.

A count of distinct students can't be added to another: whoever was active in both would count twice. A
HyperLogLog sketch of the students can be merged, so one table of hourly sketches answers for days,
weeks, or categories, without the events. Scores and last times merge as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursepulse import model
from coursepulse.functions.columns import engagement_score
from coursepulse.operators.popularity import BY_COURSE, HOUR

#: Registers of a sketch as a power of two; the relative standard error is 1.04 / sqrt(2^12) = 1.6 %,
#: and a sketch takes up to 4 KB, less where few students are.
LG_K = 12


def hourly_sketches(
    interactions: DataFrame,
    window: str = HOUR,
    by: Sequence[str] = BY_COURSE,
    weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS,
    lg_k: int = LG_K,
) -> DataFrame:
    """``by, window_start, timestamp, students, engagement_score``: a sketch of the students per window.

    Map-side partial sketches: of a hot course one per task is shuffled. Null students are in no sketch.
    """
    return _named(interactions.groupBy(*by, F.window("timestamp", window).alias("window")).agg(
        F.max("timestamp").alias("timestamp"),
        F.hll_sketch_agg("student_id", lg_k).alias("students"),
        F.sum(engagement_score(weights=weights)).cast("long").alias("engagement_score"),
    ), by)


def merged(
    sketches: DataFrame,
    window: str | None = None,
    by: Sequence[str] = BY_COURSE,
) -> DataFrame:
    """The same columns for wider windows, which have to be made of whole ones, or other groups.

    ``by`` may name any column, also one that was added to the sketches, like a course's category; without
    a ``window`` the windows stay as they are.
    """
    start = F.window("window_start", window) if window else F.struct(
        F.col("window_start").alias("start"))
    return _named(sketches.groupBy(*by, start.alias("window")).agg(
        F.max("timestamp").alias("timestamp"),
        F.hll_union_agg("students").alias("students"),
        F.sum("engagement_score").cast("long").alias("engagement_score"),
    ), by)


def _named(measured: DataFrame, by: Sequence[str]) -> DataFrame:
    return measured.select(*by, F.col("window.start").alias("window_start"), "timestamp", "students",
                           "engagement_score")


def active_users(sketch: str = "students") -> Column:
    """The number of students that a sketch stands for, about."""
    return F.hll_sketch_estimate(sketch)


def same_students(a: str | Column, b: str | Column) -> Column:
    """Whether two sketches hold the same. A sketch that was never merged estimates by its history, a
    merged one by its registers alone, so both are compared as merged ones."""
    def union(x, y):
        return F.hll_sketch_estimate(F.hll_union(x, y))
    return (union(a, a) == union(a, b)) & (union(b, b) == union(a, b))


def estimated(sketches: DataFrame, by: Sequence[str] = BY_COURSE) -> DataFrame:
    """Popularity in the columns of the exact one."""
    users = active_users()
    return sketches.select(
        *by, "window_start", "timestamp", users.cast("int").alias("active_users"),
        F.col("engagement_score").cast("int").alias("engagement_score"),
        (users + F.col("engagement_score")).cast("int").alias("total_popularity"))
