"""A session with the settings that the engine assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed joins and picks broadcast sides by measured size; times are UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(name: str = "zonalis", master: str | None = None, **extra: str) -> SparkSession:
    """``master``: left to the cluster's own configuration unless given."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | extra)
    return (builder.master(master) if master else builder).getOrCreate()
