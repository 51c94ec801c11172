"""Where a popularity stream keeps its result, and how to read it back.

==========  =========  ======================  ==================================================
mode        distinct   state grain             stored
==========  =========  ======================  ==================================================
complete    approx     (course, window)        whole table per trigger; late events always count,
                                               state never shrinks
complete    exact      (course, window,        same, rolled up per trigger
                       student)
update      approx     (course, window)        changed windows, last write wins; state bounded by
                                               the watermark, later events are dropped
update      exact      (course, window,        changed student rows, and the windows they add
                       student)                up to
append      either     as update               each window once, after the watermark passed it
==========  =========  ======================  ==================================================

Exact counting never keeps a set of students per group: the student is part of the state key, so a
hot course's state spreads over all partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse import model
from coursepulse.operators import popularity as pop
from coursepulse.sinks.tables import DIRECT, KeyedTable, VersionedTable

BatchWriter = Callable[[DataFrame, int], None]

MODES = ("complete", "update", "append")


class _Lane:
    """What one (mode, distinct) combination keeps as state and gets per trigger."""

    def __init__(self, mode: str, exact: bool):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
        self.mode, self.exact = mode, exact

    @property
    def by_student(self) -> bool:
        """Whether a trigger yields single students' changes, which cannot be rolled up alone."""
        return self.exact and self.mode == "update"

    def aggregate(self, interactions: DataFrame, window: str, weights) -> DataFrame:
        """The stateful part of the query."""
        if not self.exact:
            return pop.approximate(interactions, window, weights=weights)
        activity = pop.student_activity(interactions, window, weights=weights)
        return pop.roll_up(activity) if self.mode == "append" else activity

    def windows_of(self, batch: DataFrame) -> DataFrame:
        """Popularity rows of one trigger's output."""
        return pop.with_total(
            pop.roll_up(batch) if self.exact and self.mode == "complete" else batch)


class PopularityStore(_Lane):
    """Hourly (or other windowed) course popularity maintained by one stream or several.

    In complete mode the ``keep`` newest snapshots stay, so that a reader may take that many
    triggers to finish. In exact update mode the students' rows are kept beside the windows that they
    add up to; each trigger adds up anew only the windows it changed, reading just the days they are on,
    which the trigger's own folders name. ``compact_every`` so many triggers the stream settles the
    batches of its days, so that what a trigger reads doesn't grow with their number; readers may then
    have to repeat a read that began before.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        mode: str = "update",
        exact: bool = False,
        keep: int = 10,
        compact_every: int | None = None,
    ):
        super().__init__(mode, exact)
        self.keep, self.compact_every = keep, compact_every
        if mode == "complete":
            self.table = VersionedTable(spark, path, model.COURSE_POPULARITY_HOURLY)
        else:
            self.table = KeyedTable(spark, f"{path}/windows", model.COURSE_POPULARITY_HOURLY)
        self.students = KeyedTable(
            spark, f"{path}/students", model.STUDENT_ACTIVITY) if self.by_student else None

    @property
    def keyed(self) -> list[KeyedTable]:
        """The tables that can be compacted."""
        return [table for table in (self.table, self.students) if isinstance(table, KeyedTable)]

    def write(self, batch: DataFrame, number: int, writer: str = DIRECT) -> DataFrame | None:
        """Store a trigger's output, read once; returns the windows it changed, if any."""
        if self.mode == "complete":
            self.table.write_version(self.windows_of(batch), number, writer)
            self.table.prune(self.keep)
            return None
        changed = self._write_changes(batch, number, writer)
        if self.compact_every and number and number % self.compact_every == 0:
            for table in self.keyed:
                table.compact()
        return changed

    def _write_changes(self, batch: DataFrame, number: int, writer: str) -> DataFrame | None:
        if not self.by_student:
            self.table.write_batch(self.windows_of(batch), number, writer)
            return None
        self.students.write_batch(
            batch.withColumn("window_start", F.col("window.start")), number, writer)
        written = self.students.batch(number, writer)  # files, so the state isn't read again
        if written is None:
            return None
        changed = self.added_up(
            written.select("course_code", "window_start").distinct(),
            self.students.days_of(number, writer))
        self.table.write_batch(changed, number, writer)
        return changed

    def added_up(self, windows: DataFrame, days: list[str]) -> DataFrame:
        """The popularity of these windows, which are on these days, from the students' rows."""
        rows = self.students.latest(days=days).join(
            windows, ["course_code", "window_start"], "left_semi")
        return pop.with_total(pop.roll_up(rows, window_column="window_start"))

    def replace_windows(self, interactions: DataFrame, windows: DataFrame, window: str = pop.HOUR,
                        weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS) -> None:
        """Write these (course, window start) anew, counted from all their events."""
        if self.mode == "complete":
            raise ValueError("complete mode has counted late events already")
        by = ["course_code", "window_start"]
        if not self.exact:
            counted = pop.popularity(interactions, window, weights=weights, exact=False)
            self.table.append(counted.join(windows, by, "left_semi"))
            return
        activity = pop.student_activity(interactions, window, weights=weights).withColumn(
            "window_start", F.col("window.start")).join(windows, by, "left_semi").drop("window")
        if self.by_student:
            name = self.students.append(activity)
            activity = self.students.batch(*name)  # files, read once more in place of all events
        if activity is not None:
            self.table.append(pop.with_total(pop.roll_up(activity, window_column="window_start")))

    def windows(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """Popularity per course and window; the bounds on the windows' starts reach the scan and
        skip whole days of a compacted table."""
        if self.mode != "complete":
            return self.table.latest(since, until)
        rows = self.table.newest()
        if since:
            rows = rows.filter(F.col("window_start") >= F.lit(since))
        return rows.filter(F.col("window_start") < F.lit(until)) if until else rows

    def current(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The keyed course table: the latest window, within the bounds, of each course."""
        return pop.published(pop.current_popularity(self.windows(since, until)))

    def top(self, n: int = 10, since: datetime | None = None,
            until: datetime | None = None) -> DataFrame:
        return pop.top_courses(self.windows(since, until), n)


class ExternalPopularity(_Lane):
    """The same stream into a keyed store behind a connector.

    Complete mode writes the course table (latest window per course), all of it every trigger.
    The other modes write changed windows for a store keyed by course and window start: a course
    key alone would let a late change of an old window replace a newer one. Exact update mode needs
    a ``PopularityStore`` besides, which adds up the students.
    """

    def __init__(self, writer: BatchWriter, mode: str = "complete", exact: bool = False,
                 students: PopularityStore | None = None):
        super().__init__(mode, exact)
        if self.by_student and students is None:
            raise ValueError("exact update mode needs a PopularityStore to add students up")
        self.writer, self.students = writer, students

    def write(self, batch: DataFrame, number: int, writer: str = DIRECT) -> None:
        if self.by_student:
            windows = self.students.write(batch, number, writer)
            if windows is not None:
                self.writer(windows, number)
            return
        windows = self.windows_of(batch)
        if self.mode == "complete":
            windows = pop.published(pop.current_popularity(windows))
        self.writer(windows, number)
