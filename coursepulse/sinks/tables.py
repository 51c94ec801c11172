"""Keyed and versioned tables on plain Parquet folders, written by Spark's dynamic partition overwrite.

``KeyedTable`` gives a primary-key table without MERGE. A batch lies in partitions of its own, by the
UTC day of the key's time, its writer and its number, so writing it again replaces just these, and
any number of writers share a table without knowing of each other. Reading keeps the last write per
key, as a max over one struct: the time the batch was first written, then its position in the feed, then
the values. A key belongs to one day, so bounds on the key's time skip whole days.

``VersionedTable`` holds whole snapshots: readers take the newest complete one, so there is no moment
with an empty table. Layout below a table's path::

    rows/day=<d>/writer=<w>/batch=<n>/     a batch's rows; day=none: rows without a full key
    versions/<time>-<writer>-<number>/     snapshots
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse.model import TableSpec
from coursepulse.operators.latest import has_key, latest_by_key
from coursepulse.workspace import delete_folder, file_names, matching, path_exists

#: Writer of batches that name none.
DIRECT = "direct"
#: Start of the names of writers that write once and never repeat a batch.
ONCE = "once-"

_NO_DAY, _ONE_DAY = "none", "all"
_WRITTEN = T.StructField("written_at", T.TimestampType())
_PLACE = [T.StructField("day", T.StringType()), T.StructField("writer", T.StringType()),
          T.StructField("batch", T.LongType())]


class Batch(NamedTuple):
    """The name of a batch: repeating it replaces it."""

    number: int
    writer: str


class Stored(NamedTuple):
    """A folder with some rows of a batch."""

    day: str
    writer: str
    number: int

    @property
    def folder(self) -> str:
        return f"day={self.day}/writer={self.writer}/batch={self.number}"

    @classmethod
    def parse(cls, path: str) -> Stored:
        day, writer, number = (part.split("=", 1)[1] for part in path.rsplit("/", 3)[1:])
        return cls(day, writer, int(number))


def known(writer: str) -> str:
    """A writer's name as it stands in folder names."""
    return re.sub(r"[^A-Za-z0-9_.-]", "_", writer)


class KeyedTable:
    """One current row per key of ``spec``; the last write wins.

    Which write is the last goes by the clocks of the drivers that write. A repeated batch keeps the time
    of its first attempt. Only a writer's newest batch may be repeated, as streams do.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self.rows = f"{self.path}/rows"
        self._stored = T.StructType([*spec.schema.fields, *spec.order, _WRITTEN])
        self._schema = T.StructType([*self._stored.fields, *_PLACE])
        self._order = [_WRITTEN.name, *spec.order_columns]

    # --- writing ---

    def write_batch(self, rows: DataFrame, number: int, writer: str = DIRECT,
                    rebalance: bool = False) -> None:
        """Store one batch; writing it again under the same name replaces it.

        Map-only: rows are sorted by key within their task, so that row-group statistics serve key
        lookups. With ``rebalance`` a batch of many days is shuffled by day first, for files of a good
        size; a large day is split. Order columns the rows lack are stored as null.
        """
        writer = known(writer)
        columns = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in self._stored.fields[:-1]]
        day = F.when(has_key(self.spec.key), self._day()).otherwise(F.lit(_NO_DAY))
        placed = rows.select(*columns).select(
            "*", F.lit(self._written_at(number, writer)).cast("timestamp").alias(_WRITTEN.name),
            day.alias("day"), F.lit(writer).alias("writer"),
            F.lit(number).cast("long").alias("batch"))
        if rebalance:
            placed = placed.hint("rebalance", "day")
        self._write(placed)

    def append(self, rows: DataFrame) -> Batch:
        """Store rows as a batch of a new writer and return its name. For loads of any size and span."""
        batch = Batch(0, f"{ONCE}{uuid.uuid4().hex}")
        self.write_batch(rows, *batch, rebalance=True)
        return batch

    def _write(self, placed: DataFrame) -> None:
        places = [field.name for field in _PLACE]
        (
            placed.sortWithinPartitions(*places, *self.spec.key)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*places).parquet(self.rows)
        )

    def _written_at(self, number: int, writer: str) -> datetime:
        """The time of the batch's first attempt, which a repeated one keeps."""
        found = self.folders(writer=writer, number=number)
        first = self._read(found).select(_WRITTEN.name).first() if found else None
        return first[0].astimezone(UTC) if first else datetime.now(UTC)

    # --- reading ---

    def latest(self, since: datetime | None = None, until: datetime | None = None,
               days: Iterable[str] | None = None) -> DataFrame:
        """The current row of every key, or of the keys with a time in [since, until) or on the given
        UTC days.

        The time is part of the key, so the bounds hold for every version of a row: other days aren't
        listed, and the bounds reach the scan.
        """
        time = self.spec.key_time
        if (since or until or days is not None) and not time:
            raise ValueError(f"the key of {self.spec.name} has no time")
        chosen = [
            day for day in (self.days() if days is None else sorted(set(days) & set(self.days())))
            if not (since and day < str(since.astimezone(UTC).date()))
            and not (until and day > str(until.astimezone(UTC).date()))]
        rows = self._scan([f"day={day}" for day in chosen])
        if since:
            rows = rows.filter(F.col(time) >= F.lit(since))
        if until:
            rows = rows.filter(F.col(time) < F.lit(until))
        return self._settled(rows).select(*self.spec.columns)

    def batch(self, number: int, writer: str = DIRECT) -> DataFrame | None:
        """The keyed rows of one batch as written; None if there are none, or no more."""
        found = self._keyed_folders(number, writer)
        return self._read(found).select(*self.spec.columns) if found else None

    def days_of(self, number: int, writer: str = DIRECT) -> list[str]:
        """The UTC days one batch has keyed rows on."""
        return [one.day for one in self._keyed_folders(number, writer)]

    def _keyed_folders(self, number: int, writer: str) -> list[Stored]:
        return [one for one in self.folders(writer=known(writer), number=number)
                if one.day != _NO_DAY]

    def lookup(
        self, since: datetime | None = None, until: datetime | None = None, **key
    ) -> DataFrame:
        """Current rows with these leading key values, in order of the remaining key.

        The condition is on key columns, so it reaches the scan below the settling. Without bounds on
        the time every day is looked into; :class:`~coursepulse.sinks.bucketed.BucketedTable` isn't
        split by day.
        """
        rows = self.latest(since, until)
        for name, value in key.items():
            if name not in self.spec.key:
                raise ValueError(f"{name} is not part of the key of {self.spec.name}")
            rows = rows.filter(F.col(name) == F.lit(value))
        rest = [name for name in self.spec.key if name not in key]
        return rows.orderBy(*rest) if rest else rows

    def in_key_order(self) -> DataFrame:
        """All current rows in key order, e.g. every student's events in time order."""
        return self.latest().orderBy(*self.spec.key)

    def rejected(self) -> DataFrame:
        """Rows stored without a full key, with the batch they came in."""
        path = f"day={_NO_DAY}"
        rows = self._scan([path] if path_exists(self.spark, f"{self.rows}/{path}") else [])
        return rows.select(*self.spec.columns, "writer", "batch")

    def days(self) -> list[str]:
        """The UTC days that have rows, by one listing."""
        days = (name.split("=", 1)[1] for name in file_names(self.spark, self.rows)
                if name.startswith("day="))
        return sorted(day for day in days if day != _NO_DAY)

    def folders(self, day: str = "*", writer: str = "*", number: int | str = "*") -> list[Stored]:
        """Where rows lie, by one listing."""
        pattern = f"{self.rows}/day={day}/writer={writer}/batch={number}"
        return sorted(map(Stored.parse, matching(self.spark, pattern)))

    # --- maintenance ---

    def compact(self) -> bool:
        """Settle the batches of each day that has several into one; False if no day has.

        Rows keep the time they were written at, so what a read returns is the same before, after, and
        while both are there: a compaction that ends half-way, runs twice, or beside writers and other
        compactions, changes nothing. The newest batch of a writer is left out, as it may be repeated.
        A read that began before may miss the files it wanted and has to be repeated.
        """
        found = [one for one in self.folders() if one.day != _NO_DAY]
        newest: dict[str, int] = {}
        for one in found:
            newest[one.writer] = max(one.number, newest.get(one.writer, one.number))
        by_day: dict[str, list[Stored]] = {}
        for one in found:
            if one.writer.startswith(ONCE) or one.number < newest[one.writer]:
                by_day.setdefault(one.day, []).append(one)
        folded = [one for day in by_day.values() if len(day) > 1 for one in day]
        if not folded:
            return False
        rows = self._settled(self._read(folded)).select(
            *self._stored.names, self._day().alias("day"),
            F.lit(f"{ONCE}{uuid.uuid4().hex}").alias("writer"), F.lit(0).cast("long").alias("batch"))
        self._write(rows.hint("rebalance", "day"))
        for one in folded:
            delete_folder(self.spark, f"{self.rows}/{one.folder}", self.rows)
        return True

    # --- rows ---

    def _day(self) -> Column:
        """The UTC day of the key's time, whatever the session's zone."""
        if not self.spec.key_time:
            return F.lit(_ONE_DAY)
        days = F.floor(F.unix_seconds(self.spec.key_time) / 86400)
        return F.date_from_unix_date(days.cast("int")).cast("string")

    def _read(self, folders: list[Stored]) -> DataFrame:
        return self._scan([one.folder for one in folders])

    def _scan(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).option("basePath", self.rows).parquet(
            *[f"{self.rows}/{folder}" for folder in folders])

    def _settled(self, rows: DataFrame) -> DataFrame:
        return latest_by_key(rows.select(*self._stored.names), self.spec.key, self._order)


class VersionedTable:
    """A table replaced as a whole by each write.

    A snapshot is complete once Spark has put its ``_SUCCESS`` file beside it, so that setting
    (``mapreduce.fileoutputcommitter.marksuccessfuljobs``) has to stay on. The newest by the writers'
    clocks counts; a repeated one is written anew.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec

    def write_version(self, rows: DataFrame, number: int, writer: str = DIRECT) -> None:
        """Store one snapshot, newer than all that are there."""
        micros = int(datetime.now(UTC).timestamp() * 1_000_000)
        rows.select(*self.spec.columns).write.parquet(
            f"{self.path}/versions/{micros:020d}-{known(writer)}-{number}")

    def newest(self) -> DataFrame:
        complete = next(self._complete(), None)
        if complete is None:
            return self.spark.createDataFrame([], self.spec.schema)
        return self.spark.read.schema(self.spec.schema).parquet(f"{self.path}/versions/{complete}")

    def prune(self, keep: int = 2) -> None:
        """Delete what is older than the ``keep`` newest complete snapshots."""
        if keep < 1:
            raise ValueError("the newest snapshot has to stay")
        kept = [name for name, _ in zip(self._complete(), range(keep))]
        for name in self._names():
            if len(kept) == keep and name < kept[-1]:
                delete_folder(self.spark, f"{self.path}/versions/{name}")

    def _names(self) -> list[str]:
        """All snapshots, the newest first."""
        return sorted(file_names(self.spark, f"{self.path}/versions"), reverse=True)

    def _complete(self) -> Iterable[str]:
        for name in self._names():
            if path_exists(self.spark, f"{self.path}/versions/{name}/_SUCCESS"):
                yield name
