"""Newest report of a kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_reports(files: DataFrame, per: str | None = None) -> DataFrame:
    """The most recently changed report, per kind if ``per`` names a column.

    ``files`` comes from ``list_files``. Reports changed at the same moment are told
    apart by path, so the choice is stable.
    """
    kept = [per] if per else []
    reports = files.groupBy(*kept, "report").agg(F.max("modified").alias("modified"))
    newest = F.max(F.struct("modified", "report")).alias("newest")
    return (
        reports.groupBy(*kept)
        .agg(newest)
        .where(F.col("newest").isNotNull())
        .select(
            *kept,
            F.col("newest.report").alias("report"),
            F.col("newest.modified").alias("modified"),
        )
    )
