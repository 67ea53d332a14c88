"""Sums per branch and code that follow reports as they are issued, issued again or withdrawn.

A report's own sums are kept, so a new issue of it is applied as minus the old sums plus the
new ones, without reading any other report again. Each version has two small tables, the totals
and the list of which load holds each report's sums, and becomes visible by one commit
(``commits.py``); two writers of one base do not both succeed.

Amounts are whole cents (others are rounded to the nearest, ties to even) and summed as integers,
so the totals equal a full recompute after any series of reports, in any order and however rows
are partitioned.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.functions.money import cents
from balcao.sources.commits import Commit, CommitLog, LostRace

REPORT, LOAD = "report", "load"
KEY = ("branch_key", "code_key")
_SUMS = ("cents", "lines")
_TOTALS = "branch_key string, code_key string, cents bigint, lines bigint"
_LISTED = f"{REPORT} string, {LOAD} string"


class MaintainedSums:
    """Totals at ``folder``, with the sums of each report beside them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._log = CommitLog(spark, self.folder)

    @property
    def version(self) -> int:
        return self._log.newest()

    def _state(self, version: int, part: str, schema: str) -> DataFrame:
        if version == 0:
            return self.spark.createDataFrame([], schema)
        data = self._log.read(version).data
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{data}/{part}")

    def totals(self) -> DataFrame:
        """``branch_key``, ``code_key``, ``amount``, ``lines`` of all reports as last issued."""
        found = self._state(self.version, "totals", _TOTALS)
        return found.select(*KEY, (F.col("cents") / 100).alias("amount"), "lines")

    def reports(self) -> DataFrame:
        return self._state(self.version, "reports", _LISTED).select(REPORT)

    def _sums_of(self, named: DataFrame, version: int) -> DataFrame:
        """What the totals hold of the reports in ``named``."""
        listed = self._state(version, "reports", _LISTED).join(named, REPORT, "left_semi")
        loads = [r[0] for r in listed.select(LOAD).distinct().collect()]  # one name for each run that still counts
        schema = f"{REPORT} string, {_TOTALS}"
        if not loads:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.folder}/{LOAD}={name}" for name in loads]
        rows = self.spark.read.option("basePath", self.folder).schema(f"{schema}, {LOAD} string").parquet(*paths)
        return rows.join(listed, [REPORT, LOAD], "left_semi").drop(LOAD)

    def issue(self, rows: DataFrame, base: int | None = None) -> int:
        """Take in reports: each one in ``rows`` replaces its earlier issue; returns the version.

        ``rows`` has ``report``, ``branch_key``, ``code_key`` and ``amount``. Missing amounts
        count as zero.
        """
        amount = cents(F.coalesce("amount", F.lit(0.0)))
        sums = rows.groupBy(REPORT, *KEY).agg(F.sum(amount).alias("cents"), F.count(F.lit(1)).alias("lines"))
        return self._replace(sums, None, base)

    def withdraw(self, reports: DataFrame, base: int | None = None) -> int:
        """Take reports out, by their ``report`` names."""
        none = self.spark.createDataFrame([], f"{REPORT} string, {_TOTALS}")
        return self._replace(none, reports.select(REPORT).distinct(), base)

    def _replace(self, sums: DataFrame, named: DataFrame | None, base: int | None) -> int:
        base = self.version if base is None else base
        load, data = uuid.uuid4().hex, f"version={uuid.uuid4().hex}"
        path = f"{self.folder}/{LOAD}={load}"
        sums.write.parquet(path)
        issued = self.spark.read.schema(sums.schema).parquet(path)
        new = issued.select(REPORT).distinct()
        named = new if named is None else named
        retracted = self._sums_of(named, base).select(*KEY, *[(-F.col(c)).alias(c) for c in _SUMS])
        before = self._state(base, "totals", _TOTALS)
        moved = before.unionByName(issued.select(*KEY, *_SUMS)).unionByName(retracted)
        after = moved.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in _SUMS]).where("lines <> 0")
        after.write.parquet(f"{self.folder}/{data}/totals")
        listed = self._state(base, "reports", _LISTED).join(named, REPORT, "left_anti")
        listed = listed.unionByName(new.withColumn(LOAD, F.lit(load)))
        listed.write.parquet(f"{self.folder}/{data}/reports")
        try:
            self._log.claim(Commit(base + 1, data, -1, self._log.now(), data))
        except LostRace:
            for name in (data, f"{LOAD}={load}"):
                self._log.delete_data(name)
            raise
        return base + 1
