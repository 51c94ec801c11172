"""Course popularity per time window: active students plus weighted engagement.

Exact popularity is built in two grains. ``student_activity`` has one row per
(course, window, student): its shuffle key includes the student, so a course that holds a third of
all events still spreads over every task. ``roll_up`` then counts those rows per (course, window),
with map-side partial counts. Both grains are plain aggregates, so the same two functions serve
batch, complete, update and append streams.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursepulse import model
from coursepulse.functions.columns import course_category, engagement_score
from coursepulse.operators.latest import latest_by_key

HOUR = "1 hour"
BY_COURSE = ("course_code",)


def _scored(interactions: DataFrame, weights: Mapping[str, int]) -> Column:
    return F.sum(engagement_score(weights=weights)).alias("engagement_score")


def student_activity(
    interactions: DataFrame,
    window: str = HOUR,
    by: Sequence[str] = BY_COURSE,
    weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS,
) -> DataFrame:
    """Latest event and score of each student in each (``by``, window)."""
    return interactions.groupBy(
        *by, F.window("timestamp", window).alias("window"), "student_id"
    ).agg(F.max("timestamp").alias("timestamp"), _scored(interactions, weights))


def windows_of(
    interactions: DataFrame,
    window: str = HOUR,
    by: Sequence[str] = BY_COURSE,
) -> DataFrame:
    """The (``by``, window start) of each interaction that has a time."""
    placed = interactions.select(*by, F.window("timestamp", window).alias("window"))
    return placed.select(*by, F.col("window.start").alias("window_start"))


def roll_up(
    activity: DataFrame,
    by: Sequence[str] = BY_COURSE,
    window_column: str = "window",
) -> DataFrame:
    """Student activity summed up per (``by``, window); null students are not counted."""
    return activity.groupBy(*by, window_column).agg(
        F.count("student_id").alias("active_users"),
        F.max("timestamp").alias("timestamp"),
        F.sum("engagement_score").alias("engagement_score"),
    )


def approximate(
    interactions: DataFrame,
    window: str = HOUR,
    by: Sequence[str] = BY_COURSE,
    weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS,
    rsd: float = 0.05,
) -> DataFrame:
    """One-shuffle variant of the two grains, with a sketch for the distinct students."""
    return interactions.groupBy(*by, F.window("timestamp", window).alias("window")).agg(
        F.approx_count_distinct("student_id", rsd).alias("active_users"),
        F.max("timestamp").alias("timestamp"),
        _scored(interactions, weights),
    )


def with_total(
    measured: DataFrame,
    by: Sequence[str] = BY_COURSE,
    counter_type: str = "int",
) -> DataFrame:
    """Final popularity columns. Counters are ``int`` as in the table; a sum that no longer fits
    raises, pass ``bigint`` where such totals are expected."""
    start = "window.start" if "window" in measured.columns else "window_start"
    total = F.col("active_users") + F.col("engagement_score")
    return measured.select(
        *by,
        F.col(start).alias("window_start"),
        "timestamp",
        F.col("active_users").cast(counter_type).alias("active_users"),
        F.col("engagement_score").cast(counter_type).alias("engagement_score"),
        total.cast(counter_type).alias("total_popularity"),
    )


def popularity(
    interactions: DataFrame,
    window: str = HOUR,
    by: Sequence[str] = BY_COURSE,
    weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS,
    exact: bool = True,
    rsd: float = 0.05,
    counter_type: str = "int",
) -> DataFrame:
    """Popularity per (``by``, window): ``window_start``, latest event ``timestamp``,
    ``active_users``, ``engagement_score``, ``total_popularity``."""
    if exact:
        measured = roll_up(student_activity(interactions, window, by, weights), by)
    else:
        measured = approximate(interactions, window, by, weights, rsd)
    return with_total(measured, by, counter_type)


def category_popularity(interactions: DataFrame, window: str = HOUR, **options) -> DataFrame:
    """Popularity per course category and window."""
    categorised = interactions.withColumn("category", course_category())
    return popularity(categorised, window, by=("category",), **options)


def current_popularity(windows: DataFrame, by: Sequence[str] = BY_COURSE) -> DataFrame:
    """The latest window of each course."""
    return latest_by_key(windows, by, ["window_start"])


def published(windows: DataFrame) -> DataFrame:
    """Popularity in the shape of the keyed course table, without the window."""
    return windows.select(*model.COURSE_POPULARITY.columns)


def ranked(windows: DataFrame) -> DataFrame:
    """All popularity rows, most popular first; ties by course, then latest window."""
    return windows.orderBy(
        F.desc("total_popularity"), F.asc("course_code"), F.desc("window_start"))


def top_courses(windows: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most popular rows (a per-task top-n heap, no full sort)."""
    return ranked(windows).limit(n)
