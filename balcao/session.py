"""Spark session with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "balcao", **settings: str) -> SparkSession:
    """Adaptive execution does the sizing: it joins small partitions, splits skewed ones
    and broadcasts a side only once its measured size is below the threshold."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
