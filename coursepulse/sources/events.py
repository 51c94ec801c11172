"""Lift a generic event table to learner-course interactions.

The event table (``event_id, ts, user_id, event_type, value, props``) stands in for the feed where
no broker is at hand: users become students, the ``k`` property picks a course, and the five event
types map to five interaction types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse import model
from coursepulse.workspace import is_directory

# ``ts`` is stored without a zone; declaring it as an instant keeps filters pushable to the scan.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")

FIRST_STUDENT_NUMBER = 10000
FIRST_COURSE_NUMBER = 100

INTERACTION_OF = {
    "view": "course_viewed",
    "signup": "course_started",
    "purchase": "course_completed",
    "click": "video_watched",
    "error": "profile_updated",
}


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def read_nations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey", "n_name")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same table as a file stream, whether it is one file or a folder of files."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    table = f"{folder}/events.parquet"
    if is_directory(spark, table):
        return reader.parquet(table)
    return reader.option("pathGlobFilter", "events.parquet").parquet(folder)


def _interaction_type() -> Column:
    kind = F.col("event_type")
    chain = F.when(kind.isNull(), F.lit(None).cast("string"))
    for event_type, interaction_type in INTERACTION_OF.items():
        chain = chain.when(kind == event_type, F.lit(interaction_type))
    return chain


def _course_code() -> Column:
    number = F.get_json_object("props", "$.k").cast("int")
    prefixes = F.array(*[F.lit(p) for p in model.COURSE_PREFIXES])
    prefix = F.element_at(prefixes, number % len(model.COURSE_PREFIXES) + 1)
    return F.concat(prefix, (number + FIRST_COURSE_NUMBER).cast("string"))


def lift(events: DataFrame, nations: DataFrame | None = None, *keep: str) -> DataFrame:
    """Flat interactions, plus the event columns named in ``keep``.

    The country needs ``nations`` (a 25-row lookup that Spark broadcasts by its file size, and
    shuffles if it ever outgrows the broadcast threshold); without it the country is null.
    """
    if nations is None:
        country = F.lit(None).cast("string")
    else:
        events = events.join(
            nations, (F.col("user_id") % 25).cast("int") == F.col("n_nationkey"), "left")
        country = F.col("n_name")
    return events.select(
        F.concat(F.lit("S"), (F.col("user_id") + FIRST_STUDENT_NUMBER).cast("string"))
        .alias("student_id"),
        _course_code().alias("course_code"),
        _interaction_type().alias("interaction_type"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "click", F.floor("value").cast("int")).alias("duration"),
        country.alias("location_country"),
        F.lit(None).cast("string").alias("location_city"),
        *keep,
    )
