"""Derived interaction attributes, all as native expressions inside whole-stage codegen."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from coursepulse import model


def engagement_score(
    interaction_type: str = "interaction_type",
    weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS,
) -> Column:
    """Weight of an interaction; unknown and null types weigh 0."""
    kind = F.col(interaction_type)
    branches = reduce(
        lambda chain, item: chain.when(kind == item[0], F.lit(item[1])), weights.items(), F)
    return branches.otherwise(F.lit(0)) if weights else F.lit(0)


def course_category(
    course_code: str = "course_code",
    categories: Mapping[str, Sequence[str]] = model.COURSE_CATEGORIES,
    other: str = model.OTHER_CATEGORY,
) -> Column:
    """Category of a course by code prefix, first match wins; null stays null."""
    code = F.col(course_code)
    chain = F.when(code.isNull(), F.lit(None).cast("string"))
    for category, prefixes in categories.items():
        by_length = defaultdict(list)
        for prefix in prefixes:
            by_length[len(prefix)].append(prefix)
        # One hash-set probe per prefix length instead of one comparison per prefix.
        matches = [F.substring(code, 1, size).isin(found) for size, found in by_length.items()]
        chain = chain.when(reduce(Column.__or__, matches), F.lit(category))
    return chain.otherwise(F.lit(other))


def student_cohort(student_id: str = "student_id") -> Column:
    """Which courses a student leans to, from the number in the id; null when there is none."""
    number = F.substr(F.col(student_id), F.lit(2)).try_cast("bigint")
    return (
        F.when(number % 3 == 0, F.lit("technical"))
        .when(number % 4 == 0, F.lit("humanities"))
        .when(number.isNotNull(), F.lit("uniform"))
    )


def daypart(timestamp: str = "timestamp") -> Column:
    """Evening, daytime or other, by the session-zone clock at whole seconds; ends included."""
    at = F.col(timestamp)
    clock = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    chain = F.when(at.isNull(), F.lit(None).cast("string"))
    for name, (first, last) in model.DAYPARTS.items():
        chain = chain.when(clock.between(first, last), F.lit(name))
    return chain.otherwise(F.lit(model.OTHER_DAYPART))
