"""Session settings the library is designed for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def session(name: str = "tideline", settings: Mapping[str, str] | None = None) -> SparkSession:
    """A session with adaptive execution and UTC; the rest comes from the cluster."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
