"""Landed JSON files: one event per line, or one array of events per file."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse import model
from coursepulse.operators.ingest import CORRUPT, flatten, unusable_events
from coursepulse.workspace import file_names

LANDING_DATE = "event_date"
#: The day of records without a time, as Spark names its folder.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _schema(dated: bool = False) -> T.StructType:
    fields = [*model.EVENT_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())]
    return T.StructType(fields + ([T.StructField(LANDING_DATE, T.DateType())] if dated else []))


def _check_dated(spark: SparkSession, path: str) -> None:
    """Raises unless all data below ``path`` lies in folders by date."""
    names = [name for name in file_names(spark, path) if name[0] not in "._"]
    if any(letter in path for letter in "*?[{") or not names or not all(
            name.startswith(f"{LANDING_DATE}=") for name in names):
        raise ValueError(f"since and until need a folder that is split by {LANDING_DATE}: {path}")


def read_landed_lines(
    spark: SparkSession,
    path: str,
    since: date | None = None,
    until: date | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Flat interactions of the files at ``path`` (folder or glob, any Hadoop file system), and in
    ``_corrupt`` the text of each record that doesn't fit.

    The schema is fixed, so no inference pass reads the files first. ``since``/``until`` (inclusive)
    prune whole folders of a landing split by date; on any other they are an error. ``multi_line`` is
    for pretty-printed files only: such files cannot be split.
    """
    bounded = since is not None or until is not None
    if bounded:
        _check_dated(spark, path)
    events = (spark.read.schema(_schema(bounded)).option("multiLine", multi_line)
              .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    if since:
        events = events.filter(F.col(LANDING_DATE) >= F.lit(since))
    if until:
        events = events.filter(F.col(LANDING_DATE) <= F.lit(until))
    return flatten(events, CORRUPT)


def read_landed(
    spark: SparkSession,
    path: str,
    since: date | None = None,
    until: date | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """The interactions of :func:`read_landed_lines`; a record that doesn't fit is a row of nulls,
    or has nulls where a field doesn't."""
    return read_landed_lines(spark, path, since, until, multi_line).drop(CORRUPT)


def read_landed_days(spark: SparkSession, path: str, days: Sequence[str]) -> DataFrame:
    """The interactions of some days of a landing split by date, with the day as text in
    ``event_date``. Only these days' folders are listed and read."""
    schema = T.StructType([*_schema().fields, T.StructField(LANDING_DATE, T.StringType())])
    events = (spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
              .option("basePath", path).json([f"{path}/{LANDING_DATE}={day}" for day in days]))
    given = F.coalesce(LANDING_DATE, F.lit(NO_DATE)).alias(LANDING_DATE)
    return flatten(events, given)


def unusable_landed(lines: DataFrame) -> DataFrame:
    """``reason, payload`` of the lines without a known student."""
    return unusable_events(lines)


def stream_landed(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """:func:`read_landed_lines` as a stream: each new file is read once."""
    reader = spark.readStream.schema(_schema()).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten(reader.json(path), CORRUPT)
