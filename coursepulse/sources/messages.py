"""Message topics as bounded or unbounded tables (needs the Kafka connector on the classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursepulse import model


def kafka_options(servers: str, topic: str = model.TOPIC, **extra: object) -> dict[str, str]:
    """Connection options; ``extra`` may hold any connector option, e.g. ``minPartitions``."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    options.update({name: str(value) for name, value in extra.items()})
    return options


def stream_messages(
    spark: SparkSession,
    servers: str,
    topic: str = model.TOPIC,
    **extra: object,
) -> DataFrame:
    """The topic as a stream, from its end (``startingOffsets``) on the first start; afterwards the
    checkpoint decides. Bound a catch-up with ``maxOffsetsPerTrigger``."""
    options = kafka_options(servers, topic, **{"startingOffsets": "latest", **extra})
    return spark.readStream.format("kafka").options(**options).load()


def read_messages(
    spark: SparkSession,
    servers: str,
    topic: str = model.TOPIC,
    **extra: object,
) -> DataFrame:
    """The topic's present content as a batch, e.g. to re-process it."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, **extra)).load()
