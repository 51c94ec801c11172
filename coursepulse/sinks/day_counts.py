"""Interaction counts kept up to date by day, so that old days aren't read again.

Counts and last times add up: those of a pair are the sum and the maximum over its days. So each day's
are stored, and a day is counted anew only when its landed files have changed.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse.operators.ingest import identified
from coursepulse.operators.popularity import BY_COURSE
from coursepulse.sources.landing import LANDING_DATE, read_landed_days
from coursepulse.workspace import file_names, file_sizes, put_text, read_text

PAIR = ("student_id", *BY_COURSE)
_SCHEMA = T.StructType([
    *[T.StructField(name, T.StringType()) for name in PAIR],
    T.StructField("interaction_count", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField(LANDING_DATE, T.StringType()),
])


class DayCounts:
    """Counts per (student, course, day) of a landing that is split by day, below ``path``.

    ``days/event_date=<d>/`` holds a day's counts, ``seen/<d>`` what its files were when they were
    counted. Records without a known student aren't counted; those without a time are a day of their own.
    A day that is gone from the landing keeps its counts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def update(self, landing: str) -> list[str]:
        """Count the new and changed days of a landing; returns them.

        The files are noted as they were listed before they are read, so one that arrives meanwhile makes
        its day a changed one for the next update. An update that ends half-way is done again.
        """
        landing = landing.rstrip("/")
        files: dict[str, list[str]] = {}
        for path, size in file_sizes(self.spark, f"{landing}/{LANDING_DATE}=*/*").items():
            folder, name = path.rsplit("/", 2)[1:]
            files.setdefault(folder.split("=", 1)[1], []).append(f"{name}:{size}")
        marks = {day: f"{len(held)}-{crc32(','.join(sorted(held)).encode()):08x}"
                 for day, held in files.items()}
        seen = set(file_names(self.spark, f"{self.path}/seen"))
        changed = sorted(day for day, mark in marks.items() if day not in seen
                         or read_text(self.spark, f"{self.path}/seen/{day}") != mark)
        if changed:
            self._count(identified(read_landed_days(self.spark, landing, changed)))
        for day in changed:
            put_text(self.spark, f"{self.path}/seen/{day}", marks[day])
        return changed

    def _count(self, interactions: DataFrame) -> None:
        """Replace the days of these interactions. The shuffle is by pair and day, with partial counts
        before it."""
        counted = interactions.groupBy(*PAIR, LANDING_DATE).agg(
            F.count("interaction_type").alias("interaction_count"),
            F.max("timestamp").alias("timestamp"))
        (
            counted.select(*_SCHEMA.names).hint("rebalance", LANDING_DATE)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(LANDING_DATE).parquet(f"{self.path}/days")
        )

    def counts(self) -> DataFrame:
        """What :func:`~coursepulse.operators.counts.interaction_counts` gives for all events."""
        if not file_names(self.spark, f"{self.path}/days"):
            days = self.spark.createDataFrame([], _SCHEMA)
        else:
            days = self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/days")
        return days.groupBy(*PAIR).agg(
            F.sum("interaction_count").alias("interaction_count"),
            F.max("timestamp").alias("timestamp"))
