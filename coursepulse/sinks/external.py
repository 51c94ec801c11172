"""Pass-through writers for systems reached by a connector on the caller's classpath."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse import model
from coursepulse.functions.wire import encode_event


def messages(interactions: DataFrame) -> DataFrame:
    """Key and value to publish: keyed by student, so one student's events stay in order."""
    return interactions.select(
        F.col("student_id").alias("key"), encode_event().alias("value"))


def publish(interactions: DataFrame, servers: str, topic: str = model.TOPIC, **extra: object):
    """Send interactions to a topic; retries and acknowledgements are connector options."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    options.update({name: str(value) for name, value in extra.items()})
    messages(interactions).write.format("kafka").options(**options).save()


def renamed(rows: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Columns under the names the target table uses."""
    return rows.withColumnsRenamed(dict(names or {}))


def append_external(
    rows: DataFrame,
    format: str,
    options: Mapping[str, str],
    names: Mapping[str, str] | None = None,
) -> None:
    """Append to a keyed store (whose primary key makes the append an upsert)."""
    renamed(rows, names).write.format(format).options(**options).mode("append").save()


def external_batch_writer(
    format: str,
    options: Mapping[str, str],
    names: Mapping[str, str] | None = None,
):
    """The same for ``foreachBatch``; replays are harmless as the store upserts."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_external(batch, format, options, names)
    return write


@dataclass(frozen=True)
class ExternalStore:
    """A keyed store behind a connector, holding the tables under their own names.

    ``{table}`` in an option value stands for the table's name, e.g. ``{"table": "{table}"}``.
    """

    format: str
    options: Mapping[str, str] = field(default_factory=dict)

    def options_for(self, table: str) -> dict[str, str]:
        return {name: value.replace("{table}", table) for name, value in self.options.items()}

    def batch_writer(self, table: str, names: Mapping[str, str] | None = None):
        return external_batch_writer(self.format, self.options_for(table), names)

    def append(self, rows: DataFrame, table: str) -> None:
        append_external(rows, self.format, self.options_for(table))
