"""Query starters. Each returns its handle; nothing blocks until :func:`await_all`."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from coursepulse import model
from coursepulse.operators.latest import latest_by_key
from coursepulse.operators.popularity import HOUR
from coursepulse.sinks.tables import KeyedTable
from coursepulse.streaming.store import BatchWriter, ExternalPopularity, PopularityStore
from coursepulse.workspace import read_text, session_conf

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(
    writer: DataStreamWriter,
    spark: SparkSession,
    name: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None,
    settings: Mapping[str, object] | None = None,
) -> StreamingQuery:
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    with session_conf(spark, settings or {}):
        return writer.start()


def query_writer(spark: SparkSession, checkpoint: str, name: str) -> str:
    """A writer's name that belongs to the checkpoint: batch numbers start again with a new one, so
    its batches mustn't replace those of the old one. For use inside ``foreachBatch``."""
    return f"{name}-{json.loads(read_text(spark, f'{checkpoint}/metadata'))['id']}"


def _named(write, spark: SparkSession, checkpoint: str, name: str):
    """``write`` for ``foreachBatch``, with the query's name as a writer."""
    def named(batch: DataFrame, number: int) -> None:
        write(batch, number, query_writer(spark, checkpoint, name))
    return named


def start_interaction_log(
    interactions: DataFrame,
    target: KeyedTable | BatchWriter,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    dedup_delay: str | None = None,
    keep: str = "first",
    name: str = "interaction_log",
) -> StreamingQuery:
    """Append interactions to the keyed log (or to an external batch writer).

    Map-only: a repeated (student, timestamp) is settled on read, last write first. ``dedup_delay``
    drops repeats inside the stream instead, which needs state. ``keep="first"`` passes the first one on
    at once; ``keep="last"`` the last one, once the watermark is past it, see :func:`last_per_key`.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be first or last, not {keep!r}")
    if dedup_delay and keep == "last":
        interactions = last_per_key(interactions, dedup_delay)
    elif dedup_delay:
        interactions = interactions.withWatermark(
            "timestamp", dedup_delay).dropDuplicatesWithinWatermark(["student_id", "timestamp"])
    if isinstance(target, KeyedTable):
        write = _named(target.write_batch, interactions.sparkSession, checkpoint, name)
    else:
        write = target
    writer = interactions.writeStream.outputMode("append").foreachBatch(write)
    return _start(writer, interactions.sparkSession, name, checkpoint, trigger)


def last_per_key(interactions: DataFrame, delay: str) -> DataFrame:
    """The last of the interactions of each (student, timestamp), by their position in the feed, then
    their values.

    An aggregate by event time: a key's row comes out, and leaves the state, once the watermark is past
    its time; what comes for it later is dropped. Interactions without a time pass as they are.
    """
    spec = model.INTERACTION_LOGS
    order = [name for name in spec.order_columns if name in interactions.columns]
    timed = interactions.filter(F.col("timestamp").isNotNull()).withWatermark("timestamp", delay)
    return latest_by_key(timed, spec.key, order).unionByName(
        interactions.filter(F.col("timestamp").isNull()))


def start_quarantine(
    rejected: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    name: str = "quarantine",
) -> StreamingQuery:
    """Keep what yields no usable interaction, with the reason, for inspection.

    ``rejected`` is ``unusable(messages)`` of a topic, or ``unusable_landed`` of landed files.
    Map-only, one folder per batch; a repeated batch replaces its folder. Read with
    ``spark.read.parquet(path)``. Batch numbers belong to the checkpoint, so a new checkpoint needs
    a new path.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    writer = rejected.writeStream.outputMode("append").foreachBatch(write)
    return _start(writer, rejected.sparkSession, name, checkpoint, trigger)


def start_popularity(
    interactions: DataFrame,
    store: PopularityStore | ExternalPopularity,
    checkpoint: str,
    window: str = HOUR,
    watermark: str = HOUR,
    weights: Mapping[str, int] = model.ENGAGEMENT_WEIGHTS,
    trigger: Mapping[str, object] | None = None,
    state_partitions: int | None = None,
    rocksdb: bool = False,
    name: str = "course_popularity",
) -> StreamingQuery:
    """Maintain course popularity in ``store``.

    The watermark bounds state and drops later events in update and append mode; in complete mode
    it has no effect. ``state_partitions`` is frozen by the checkpoint on the first start: choose it
    for the full state, not for one batch. ``rocksdb`` keeps state off the heap.
    """
    settings: dict[str, object] = {}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = state_partitions
    if rocksdb:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    aggregated = store.aggregate(
        interactions.withWatermark("timestamp", watermark), window, weights)
    write = _named(store.write, interactions.sparkSession, checkpoint, name)
    writer = aggregated.writeStream.outputMode(store.mode).foreachBatch(write)
    return _start(writer, interactions.sparkSession, name, checkpoint, trigger, settings)


def start_console(
    rows: DataFrame,
    checkpoint: str,
    mode: str = "append",
    trigger: Mapping[str, object] | None = None,
    name: str = "console",
) -> StreamingQuery:
    """Print a stream's batches, for debugging."""
    writer = rows.writeStream.outputMode(mode).format("console").option("truncate", "false")
    return _start(writer, rows.sparkSession, name, checkpoint, trigger)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and were left out, over the triggers Spark remembers.

    In update and append mode such rows change nothing; complete mode counts them all.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress for operator in progress["stateOperators"])


def await_all(*queries: StreamingQuery) -> None:
    """Wait until every query ended; the first failure stops the others and is raised."""
    running = list(queries)
    try:
        while running:
            for query in list(running):
                if query.awaitTermination(1):
                    running.remove(query)
    finally:
        for query in running:
            query.stop()
