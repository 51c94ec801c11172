"""Continuous queries."""

from coursepulse.streaming.late import LateEvents, start_late_events
from coursepulse.streaming.queries import (
    await_all,
    late_rows,
    start_console,
    start_interaction_log,
    start_popularity,
    start_quarantine,
)
from coursepulse.streaming.store import ExternalPopularity, PopularityStore

__all__ = [
    "ExternalPopularity",
    "LateEvents",
    "PopularityStore",
    "await_all",
    "late_rows",
    "start_console",
    "start_interaction_log",
    "start_late_events",
    "start_popularity",
    "start_quarantine",
]
