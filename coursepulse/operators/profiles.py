"""Whole-feed profiles: cohorts, time of day and data quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursepulse import model
from coursepulse.functions.columns import course_category, daypart, student_cohort


def _share(of: Column, *within: str) -> Column:
    return (of / F.sum(of).over(Window.partitionBy(*within))).alias("share")


def cohort_affinity(interactions: DataFrame) -> DataFrame:
    """How each student cohort's interactions spread over course categories.

    The share runs over the aggregated rows only: cohorts x categories, both fixed vocabularies.
    """
    tallied = interactions.groupBy(
        student_cohort().alias("cohort"), course_category().alias("category")
    ).agg(F.count(F.lit(1)).alias("interactions"))
    return tallied.select("cohort", "category", "interactions",
                          _share(F.col("interactions"), "cohort"))


def daypart_profile(interactions: DataFrame) -> DataFrame:
    """Interactions and share per part of the day (three rows, plus one for missing times)."""
    tallied = interactions.groupBy(daypart().alias("daypart")).agg(
        F.count(F.lit(1)).alias("interactions"))
    return tallied.select("daypart", "interactions", _share(F.col("interactions")))


def quality_report(interactions: DataFrame) -> DataFrame:
    """One row that counts every breach of the feed's rules, in one pass."""
    kind, duration = F.col("interaction_type"), F.col("duration")
    timed = F.coalesce(kind == model.TIMED_INTERACTION, F.lit(False))
    shortest, longest = model.DURATION_RANGE_SECONDS
    checks = {
        "null_student": F.col("student_id").isNull(),
        "null_course": F.col("course_code").isNull(),
        "null_type": kind.isNull(),
        "null_timestamp": F.col("timestamp").isNull(),
        "malformed_student": ~F.col("student_id").rlike(model.STUDENT_ID_PATTERN),
        "unknown_type": ~kind.isin(*model.INTERACTION_TYPES),
        "missing_duration": timed & duration.isNull(),
        "unexpected_duration": ~timed & duration.isNotNull(),
        "duration_out_of_range": ~duration.between(shortest, longest),
    }
    return interactions.agg(
        F.count(F.lit(1)).alias("interactions"),
        *[F.count_if(check).alias(name) for name, check in checks.items()],
    )
