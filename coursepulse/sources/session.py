"""Session set-up with settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

DEFAULTS = {
    # Wire timestamps carry no zone; read them all in one.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, conf: Mapping[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; ``conf`` (connector packages, hosts, file-system
    classes and keys, resources) wins over them. Nothing deployment-specific is baked in."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
