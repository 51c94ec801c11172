"""Schemas, keys and the fixed vocabulary of learner-course interactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: the wire contract and the domain vocabulary -----------------------------

WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

TOPIC = "interaction_data"

ENGAGEMENT_WEIGHTS = {
    "course_viewed": 1,
    "course_started": 3,
    "course_completed": 7,
}

INTERACTION_TYPES = (
    "video_watched", "quiz_completed", "assignment_submitted", "forum_posted", "lesson_started",
    "lesson_completed", "certificate_earned", "course_started", "course_completed", "badge_earned",
    "course_reviewed", "video_liked", "comment_posted", "content_downloaded", "progress_shared",
    "practice_exam_taken", "feedback_submitted", "discussion_joined", "discussion_replied",
    "content_shared", "lesson_bookmarked", "profile_updated", "search_performed",
    "notification_read", "message_sent", "lesson_revisited", "course_rated",
    "content_added_to_playlist", "course_viewed",
)

TIMED_INTERACTION = "video_watched"
DURATION_RANGE_SECONDS = (20, 7200)
STUDENT_ID_PATTERN = "^S[0-9]{5}$"

COURSE_PREFIXES = (
    "CS", "CL", "CM", "MA", "SC", "HI", "PH", "BI", "EC", "PS", "EN", "GE", "AR", "LA", "PE",
)

COURSE_CATEGORIES = {
    "technical": ("CS", "CL", "CM", "MA", "EC", "BI"),
    "humanities": ("HI", "PH", "EN", "AR", "LA"),
    "science": ("SC", "PS"),
    "arts": ("PE", "GE"),
}
OTHER_CATEGORY = "others"

# Inclusive clock ranges, in seconds since midnight.
DAYPARTS = {
    "evening": (17 * 3600, 22 * 3600),
    "daytime": (8 * 3600, 16 * 3600),
}
OTHER_DAYPART = "other"

# --- Schemas -------------------------------------------------------------------------------

#: One event as it travels in a message value or a landed JSON file.
EVENT_SCHEMA = T.StructType([
    T.StructField("student_id", T.StringType()),
    T.StructField("course_code", T.StringType()),
    T.StructField("interaction_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("location", T.StructType([
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
    ])),
])

#: The same event with ``location`` flattened; every operator works on this shape.
INTERACTION_SCHEMA = T.StructType(EVENT_SCHEMA.fields[:-1] + [
    T.StructField("location_country", T.StringType()),
    T.StructField("location_city", T.StringType()),
])


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: one current row per ``key``; ``order`` columns say which write is later.

    ``order`` columns are stored with every write and dropped on read. Writes are ranked by batch
    first, then by ``order``, then by the remaining values so that replays pick the same winner.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    order: tuple[T.StructField, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def key_time(self) -> str | None:
        """The key column that is a time, if there is one."""
        times = [name for name in self.key
                 if isinstance(self.schema[name].dataType, T.TimestampType)]
        return times[0] if times else None

    @property
    def order_columns(self) -> list[str]:
        return [f.name for f in self.order]


#: Position of a message in its source, where the source has one.
INGEST_ORDER = (
    T.StructField("ingest_time", T.TimestampType()),
    T.StructField("ingest_partition", T.IntegerType()),
    T.StructField("ingest_offset", T.LongType()),
)

INTERACTION_LOGS = TableSpec(
    "interaction_logs", INTERACTION_SCHEMA, ("student_id", "timestamp"), INGEST_ORDER)

_POPULARITY_MEASURES = [
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("active_users", T.IntegerType()),
    T.StructField("engagement_score", T.IntegerType()),
    T.StructField("total_popularity", T.IntegerType()),
]

COURSE_POPULARITY = TableSpec(
    "course_popularity",
    T.StructType([T.StructField("course_code", T.StringType())] + _POPULARITY_MEASURES),
    ("course_code",),
)

COURSE_POPULARITY_HOURLY = TableSpec(
    "course_popularity_hourly",
    T.StructType([
        T.StructField("course_code", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
    ] + _POPULARITY_MEASURES),
    ("course_code", "window_start"),
)

#: Per-student contribution to one course window; sums up to COURSE_POPULARITY_HOURLY.
STUDENT_ACTIVITY = TableSpec(
    "student_activity",
    T.StructType([
        T.StructField("course_code", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("student_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("engagement_score", T.LongType()),
    ]),
    ("course_code", "window_start", "student_id"),
)

STUDENT_RECOMMENDATIONS = TableSpec(
    "student_recommendations",
    T.StructType([
        T.StructField("student_id", T.StringType()),
        T.StructField("course_code", T.StringType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("recommendation_time", T.TimestampType()),
    ]),
    ("student_id", "course_code", "recommendation_time"),
)
