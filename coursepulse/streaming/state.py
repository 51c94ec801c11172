"""What a streaming query holds as state, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0,
               batch: int | None = None) -> DataFrame:
    """``key, value`` structs of a stateful operator after a batch (by default the last one)."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key", "value")


def windows_in_state(spark: SparkSession, checkpoint: str, **options) -> DataFrame:
    """``window_start, keys``: how many keys the state of a popularity query holds per window.

    A bounded one holds none that the watermark has passed; that of complete mode holds all.
    """
    rows = state_rows(spark, checkpoint, **options)
    return rows.groupBy(F.col("key.window.start").alias("window_start")).agg(
        F.count(F.lit(1)).alias("keys"))
