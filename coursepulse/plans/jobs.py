"""The jobs a platform runs: keep the log and popularity current, recommend courses, land events.

No row vanishes: what yields no interaction is set aside with its reason, and rows without a full key
are kept by their table, in ``rejected()``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coursepulse import model
from coursepulse.operators.counts import interaction_counts
from coursepulse.operators.ingest import identified, interactions_from, unusable
from coursepulse.operators.latest import has_key, latest_by_key
from coursepulse.operators.popularity import HOUR
from coursepulse.operators.recommend import AlsSettings, fit_counts
from coursepulse.sinks.day_counts import DayCounts
from coursepulse.sinks.external import ExternalStore
from coursepulse.sinks.external import publish as send
from coursepulse.sinks.landing import land
from coursepulse.sinks.tables import KeyedTable
from coursepulse.sources.landing import read_landed_lines, unusable_landed
from coursepulse.streaming.queries import (
    query_writer,
    start_interaction_log,
    start_popularity,
)
from coursepulse.streaming.store import BatchWriter, ExternalPopularity, PopularityStore
from coursepulse.workspace import file_names, stored, working_dir


@dataclass(frozen=True)
class Tables:
    """The three tables below one root folder."""

    spark: SparkSession
    root: str

    @property
    def interaction_logs(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/interaction_logs", model.INTERACTION_LOGS)

    def course_popularity(self, mode: str = "update", exact: bool = False,
                          window: str = HOUR) -> PopularityStore:
        return PopularityStore(
            self.spark, f"{self.root}/course_popularity/{_lane(mode, exact, window)}", mode, exact)

    @property
    def student_recommendations(self) -> KeyedTable:
        return KeyedTable(
            self.spark, f"{self.root}/student_recommendations", model.STUDENT_RECOMMENDATIONS)

    def keyed(self) -> list[KeyedTable]:
        """Every keyed table, those of all popularity lanes included."""
        lanes = []
        for name in file_names(self.spark, f"{self.root}/course_popularity"):
            mode, distinct, _ = name.split("-", 2)
            lanes += PopularityStore(self.spark, f"{self.root}/course_popularity/{name}", mode,
                                     distinct == "exact").keyed
        return [self.interaction_logs, self.student_recommendations, *lanes]


def _lane(mode: str, exact: bool, window: str) -> str:
    """What results, and state, of differently set up popularity queries go by."""
    return f"{mode}-{'exact' if exact else 'approx'}-{'_'.join(window.split())}"


def popularity_job(
    interactions: DataFrame,
    tables: Tables,
    checkpoints: str,
    mode: str = "update",
    exact: bool = False,
    trigger: Mapping[str, object] | None = None,
    store: ExternalStore | None = None,
    window: str = HOUR,
    **options,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two independent queries over one feed: the interaction log and course popularity.

    ``interactions`` is a stream, from a topic (``interactions_from(stream_messages(...))``) or from
    landed files. Each query has its own checkpoint and reads the feed for itself; wait on both
    with ``await_all``. With ``store`` both write to that keyed store instead of ``tables``; it has
    no batch order, so the log's repeats are settled within each batch before they get there, and
    rows without a full key go to the log table's ``rejected()``.
    """
    lane = _lane(mode, exact, window)
    if store:
        log_target = _deduplicating(store.batch_writer(model.INTERACTION_LOGS.name),
                                    tables.interaction_logs, f"{checkpoints}/interaction_log")
        popularity_spec = (
            model.COURSE_POPULARITY if mode == "complete" else model.COURSE_POPULARITY_HOURLY)
        popularity_target = ExternalPopularity(
            store.batch_writer(popularity_spec.name), mode, exact,
            tables.course_popularity(mode, exact, window) if mode == "update" and exact else None)
    else:
        log_target = tables.interaction_logs
        popularity_target = tables.course_popularity(mode, exact, window)
    log = start_interaction_log(
        interactions, log_target, f"{checkpoints}/interaction_log", trigger)
    try:
        popularity = start_popularity(
            interactions, popularity_target, f"{checkpoints}/course_popularity-{lane}", window,
            trigger=trigger, **options)
    except Exception:
        log.stop()
        raise
    return log, popularity


def _deduplicating(write: BatchWriter, table: KeyedTable, checkpoint: str) -> BatchWriter:
    """Write the last interaction per key of each batch, in the columns of the log table; the rows
    the store would refuse for a missing key are kept by ``table``."""
    spec = model.INTERACTION_LOGS

    def deduplicated(batch: DataFrame, number: int) -> None:
        order = [name for name in spec.order_columns if name in batch.columns]
        table.write_batch(batch.filter(~has_key(spec.key)), number,
                          query_writer(table.spark, checkpoint, "external"))
        keyed = batch.filter(has_key(spec.key))
        write(latest_by_key(keyed, spec.key, order).select(*spec.columns), number)
    return deduplicated


def recommendation_job(
    spark: SparkSession,
    interactions: DataFrame | DayCounts,
    tables: Tables,
    n: int = 5,
    exclude_seen: bool = False,
    settings: AlsSettings = AlsSettings(),
    store: ExternalStore | None = None,
) -> DataFrame:
    """Fit on all interactions, store every student's top ``n`` and return the table.

    ``interactions`` may be a ``DayCounts`` instead, whose counts are used; then no old day is read.

    With ``store`` the table's new rows are appended there as well.

    The model is saved before anything is scored, the scored rows are written once, and the
    working files go away afterwards.
    """
    counts = (interactions.counts() if isinstance(interactions, DayCounts)
              else interaction_counts(interactions))
    recommender = fit_counts(spark, counts, settings)
    try:
        table = tables.student_recommendations
        rows = recommender.recommendations(n, exclude_seen).select(*table.spec.columns)
        if store:
            rows = stored(rows, f"{recommender.folder}/recommendations")
            store.append(rows, table.spec.name)
        table.append(rows)
    finally:
        recommender.discard()
    return tables.student_recommendations.latest()


# --- landed files and topics ----------------------------------------------------------------


class Moved(NamedTuple):
    """What a job did with its rows. ``taken`` and ``aside`` add up to what it read; ``aside`` lies
    in ``folder`` as ``reason, payload``."""

    taken: int
    aside: int
    folder: str


def set_aside(rejected: DataFrame, folder: str) -> int:
    """Add ``reason, payload`` rows to a folder of their own below ``folder``; returns how many."""
    path = f"{folder}/set-{uuid.uuid4().hex}"
    return stored(rejected, path).count()


def _split_landed(spark: SparkSession, path: str, aside: str, **dates) -> tuple[DataFrame, int]:
    """The usable interactions of landed files, read once into a working table, and the number of
    records set aside."""
    lines = stored(read_landed_lines(spark, path, **dates), working_dir(spark, "lines"))
    return identified(lines).drop("_corrupt"), set_aside(unusable_landed(lines), aside)


def ingest_landed(spark: SparkSession, path: str, tables: Tables, **dates) -> Moved:
    """Load landed files into the interaction log as one batch.

    Records without a student are set aside below ``<root>/unusable``; those without a time are in
    the log's ``rejected()`` and count as taken.
    """
    folder = f"{tables.root}/unusable"
    usable, aside = _split_landed(spark, path, folder, **dates)
    tables.interaction_logs.append(usable)
    return Moved(usable.count(), aside, folder)


def publish_landed(spark: SparkSession, path: str, servers: str, topic: str, aside: str,
                   **options) -> Moved:
    """Publish the usable interactions of landed files, and set the other records aside."""
    usable, count = _split_landed(spark, path, aside)
    send(usable, servers, topic, **options)
    return Moved(usable.count(), count, aside)


def replay_to_landing(messages: DataFrame, path: str, rebalance: bool = False,
                      aside: str | None = None) -> Moved:
    """Land the usable interactions of a bounded feed by date, those without a time in a folder of
    their own; the other messages are set aside (by default in ``<path>-unusable``)."""
    spark = messages.sparkSession
    aside = aside or f"{path.rstrip('/')}-unusable"
    given = stored(messages.select("value", *[c for c in messages.columns if c != "value"]),
                   working_dir(spark, "messages"))
    usable = interactions_from(given)
    land(usable, path, by_date=True, rebalance=rebalance)
    count = set_aside(unusable(given), aside)
    return Moved(given.count() - count, count, aside)
