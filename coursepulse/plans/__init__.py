"""End-to-end jobs made of sources, operators and sinks."""

from coursepulse.plans.jobs import (
    Moved,
    Tables,
    ingest_landed,
    popularity_job,
    publish_landed,
    recommendation_job,
    replay_to_landing,
)

__all__ = [
    "Moved",
    "Tables",
    "ingest_landed",
    "popularity_job",
    "publish_landed",
    "recommendation_job",
    "replay_to_landing",
]
