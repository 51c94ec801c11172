"""Column expressions."""

from coursepulse.functions.columns import (
    course_category,
    daypart,
    engagement_score,
    student_cohort,
)
from coursepulse.functions.wire import decode_event, encode_event

__all__ = [
    "course_category",
    "daypart",
    "decode_event",
    "encode_event",
    "engagement_score",
    "student_cohort",
]
