"""Where interactions and results go."""

from coursepulse.sinks.bucketed import BucketedTable
from coursepulse.sinks.day_counts import DayCounts
from coursepulse.sinks.external import ExternalStore, append_external, publish
from coursepulse.sinks.landing import land
from coursepulse.sinks.tables import Batch, KeyedTable, VersionedTable

__all__ = [
    "Batch",
    "BucketedTable",
    "DayCounts",
    "ExternalStore",
    "KeyedTable",
    "VersionedTable",
    "append_external",
    "land",
    "publish",
]
