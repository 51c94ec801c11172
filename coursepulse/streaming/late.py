"""Late events kept aside, and the windows they belong to counted anew.

In update and append mode a popularity stream drops what comes behind its watermark: that bounds its
state. ``start_late_events`` reads the same feed, keeps no state, and stores those events; ``repair``
then counts just the windows they touch again, from all events of these windows, and writes them as a
later version. So the table becomes what complete mode has, whose state never shrinks.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coursepulse import model
from coursepulse.operators import popularity as pop
from coursepulse.operators.popularity import HOUR
from coursepulse.sinks.tables import DIRECT, known
from coursepulse.streaming.queries import _named, _start
from coursepulse.streaming.store import PopularityStore
from coursepulse.workspace import (
    delete_folder,
    file_names,
    matching,
    path_exists,
    put_text,
    read_text,
)

_DAY, _MOST_RANGES = 86400, 100


class LateEvents:
    """Events behind the watermark, one folder per batch, and how far each writer's feed has come.

    ``aligned`` says whose batches the watermark goes by. A popularity query moves it between its
    batches. With its batches (the same source, options and start) the very events it drops are late.
    With batches of any other cut, a batch's own events move the watermark too; then more events may be
    late than were dropped, but none less, and some windows are counted anew for nothing.
    """

    def __init__(self, spark: SparkSession, path: str, window: str = HOUR, watermark: str = HOUR,
                 aligned: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        self.window, self.watermark, self.aligned = window, watermark, aligned

    def write(self, batch: DataFrame, number: int, writer: str = DIRECT) -> None:
        """Store the late ones of a batch; writing it again replaces it. Two passes over the batch, the
        first for its latest time."""
        writer = known(writer)
        latest = batch.agg(F.unix_millis(F.max("timestamp"))).first()[0]
        before = self._reached(writer, number - 1)
        after = max((at for at in (before, latest) if at is not None), default=None)
        bound = before if self.aligned else after
        folder = f"{self.path}/events/writer={writer}/batch={number}"
        if bound is None:
            delete_folder(self.spark, folder)
        else:
            watermark = F.timestamp_millis(F.lit(bound)) - F.expr(f"interval {self.watermark}")
            late = F.window("timestamp", self.window).end <= watermark
            batch.filter(late).select(*model.INTERACTION_SCHEMA.names).write.mode(
                "overwrite").parquet(folder)
        if after is not None:
            put_text(self.spark, self._progress(writer, number), f"{after}")

    def _progress(self, writer: str, number: int) -> str:
        return f"{self.path}/progress/{writer}/{number}"

    def _reached(self, writer: str, number: int) -> int | None:
        """The latest time of a writer's batches up to this one, in milliseconds."""
        path = self._progress(writer, number)
        return int(read_text(self.spark, path)) if path_exists(self.spark, path) else None

    def folders(self) -> list[str]:
        return sorted(matching(self.spark, f"{self.path}/events/writer=*/batch=*"))

    def events(self) -> DataFrame:
        """The late events that no repair has taken yet."""
        return self._read(self.folders())

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], model.INTERACTION_SCHEMA)
        return self.spark.read.schema(model.INTERACTION_SCHEMA).parquet(*folders)

    def repair(self, store: PopularityStore, interactions: DataFrame,
               weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS) -> int:
        """Count the windows of the late events anew from ``interactions``, all events from which the
        store is fed, and forget the late events; returns how many windows that were.

        Only events of these windows' days are read. A repair that is repeated, or ends half-way, does
        no harm.
        """
        folders = self.folders()
        touched = pop.windows_of(self._read(folders), self.window).distinct()
        day = F.floor(F.unix_seconds("window_start") / _DAY)
        windows, days = touched.agg(F.count(F.lit(1)), F.collect_set(day)).first()
        if windows:
            store.replace_windows(
                interactions.filter(self._near(sorted(days))), touched, self.window, weights)
        for folder in folders:
            delete_folder(self.spark, folder)
        self._forget_progress()
        return windows

    def _near(self, days: list[int]) -> Column:
        """Whether an event can be in a window that begins on one of these UTC days, as bounds on its
        time, which reach a scan: one range per run of days, or one for all if these are many."""
        starts = [day for day in days if day - 1 not in set(days)]
        ends = [day for day in days if day + 1 not in set(days)]
        if len(starts) > _MOST_RANGES:
            starts, ends = days[:1], days[-1:]
        found = F.lit(False)
        for start, end in zip(starts, ends):
            low, high = (F.timestamp_seconds(F.lit(at * _DAY)) for at in (start, end + 1))
            found = found | ((F.col("timestamp") >= low) & (
                F.col("timestamp") < high + F.expr(f"interval {self.window}")))
        return found

    def _forget_progress(self) -> None:
        """Keep only the newest progress of each writer."""
        for writer in file_names(self.spark, f"{self.path}/progress"):
            folder = f"{self.path}/progress/{writer}"
            numbers = sorted(int(name) for name in file_names(self.spark, folder) if name.isdigit())
            for number in numbers[:-2]:  # the last batch may be repeated, from the one before it
                delete_folder(self.spark, f"{folder}/{number}")


def start_late_events(
    interactions: DataFrame,
    late: LateEvents,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str = "late_events",
) -> StreamingQuery:
    """Keep the events that a popularity query over this feed drops. Without state or shuffle."""
    write = _named(late.write, interactions.sparkSession, checkpoint, name)
    writer = interactions.writeStream.outputMode("append").foreachBatch(write)
    return _start(writer, interactions.sparkSession, name, checkpoint, trigger)
