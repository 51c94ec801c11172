"""Land interactions as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.functions.wire import wire_columns
from coursepulse.sources.landing import LANDING_DATE


def land(
    interactions: DataFrame,
    path: str,
    by_date: bool = False,
    rebalance: bool = False,
) -> None:
    """Append JSON lines under ``path``; part files have unique names.

    Map-only by default. With ``by_date`` each day gets a folder that readers can prune, and rows
    without a time one of their own; ``rebalance`` then shuffles so that files get near
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: small days share a task, and a day with most
    of the rows is split over as many tasks as its size asks for.
    """
    columns = wire_columns()
    if not by_date:
        events = interactions.select(*columns)
        events.write.mode("append").option("ignoreNullFields", "false").json(path)
        return
    events = interactions.select(*columns, F.to_date("timestamp").alias(LANDING_DATE))
    if rebalance:
        events = events.hint("rebalance", LANDING_DATE)
    (events.write.mode("append").partitionBy(LANDING_DATE)
     .option("ignoreNullFields", "false").json(path))
