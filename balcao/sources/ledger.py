"""A ledger of loaded files: a folder is read once, and only what has changed is read again.

The manifest has one row for each report (a file, or a directory of part files): path, size,
time of change, digest of its lines, and the load that its rows come from. A run lists the
folder, sets aside what the manifest knows with the same size and time, and takes the digest of
the rest. Reports with a new digest are read; their rows go into one folder for the load. The
manifest is a snapshot (``snapshots.py``), so a load becomes visible, and earlier rows of its
reports are replaced, in one commit; of two loads with the same base one gets ``LostRace``.

The table is what a fresh load of the folder would give: reports that are gone leave it (unless
``keep_missing``), copies under another name count as reports of their own, unreadable reports
have no rows. What has not changed is not opened, and a repeated run commits nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.operators.ordered import FILE, ROW
from balcao.sources.commits import CommitLog
from balcao.sources.lines import list_files, read_lines, report_path
from balcao.sources.snapshots import NoSnapshot, expire_snapshots, latest_snapshot, newest_version, write_snapshot
from balcao.sources.staging import staged

REPORT = "report"
LOAD = "load"
_MANIFEST = "manifest"
_COLUMNS = f"{REPORT} string, bytes bigint, modified timestamp, digest string, {LOAD} string"
_FATE = "fate"

Scan = Callable[[SparkSession, "str | list[str]"], DataFrame]


@dataclass(frozen=True)
class Loaded:
    """How many reports a run found in each state."""

    new: int = 0
    changed: int = 0
    touched: int = 0  # another time or size of file, the same lines
    unchanged: int = 0
    gone: int = 0

    @property
    def committed(self) -> bool:
        return bool(self.new or self.changed or self.touched or self.gone)


class Ledger:
    """The table at ``folder``, filled from report files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @property
    def _manifests(self) -> str:
        return f"{self.folder}/{_MANIFEST}"

    def manifest(self) -> DataFrame:
        try:
            return latest_snapshot(self.spark, self._manifests, even_if_empty=True)
        except NoSnapshot:
            return self.spark.createDataFrame([], _COLUMNS)

    def table(self, schema=None) -> DataFrame:
        """All rows of the reports as they were loaded last, with the ``file`` they come from.

        ``schema`` names the columns of a table that has no load yet.
        """
        manifest = self.manifest()
        # One name for each load that still has a report; old loads are rewritten by compact.
        loads = [r[0] for r in manifest.select(LOAD).distinct().collect()]
        if not loads:
            return self.spark.createDataFrame([], schema or f"{FILE} string")
        rows = self.spark.read.option("basePath", self.folder).parquet(*[f"{self.folder}/{LOAD}={n}" for n in loads])
        rows = rows.withColumn("__report", report_path(F.col(FILE)))
        live = manifest.select(F.col(REPORT).alias("__report"), F.col(LOAD).alias("__load"))
        same = (F.col(f"r.{LOAD}") == F.col("m.__load")) & (F.col("r.__report") == F.col("m.__report"))
        return rows.alias("r").join(live.alias("m"), same, "left_semi").drop(LOAD, "__report")

    def _listed(self, folder: str, glob: str) -> DataFrame:
        files = list_files(self.spark, folder, glob)
        return files.groupBy(REPORT).agg(F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))

    def _digests(self, places: str | list[str], glob: str, suspects: DataFrame) -> DataFrame:
        """Of the suspects' lines, in their order; put together from sums, so lines may be split up."""
        lines = read_lines(self.spark, places, glob).withColumn(REPORT, report_path(F.col(FILE)))
        lines = lines.join(suspects.select(REPORT), REPORT, "left_semi")
        at = F.col(ROW) if ROW in lines.columns else F.lit(0)
        sums = [
            F.sum(F.xxhash64(F.lit(seed), at, F.col("raw")).cast("decimal(38,0)")).cast("string") for seed in (1, 2)
        ]
        counted = F.count(F.lit(1)).cast("string")
        return lines.groupBy(REPORT).agg(F.concat_ws(":", counted, *sums).alias("digest"))

    def _compared(self, folder: str, glob: str, before: DataFrame) -> tuple[DataFrame, str | list[str]]:
        """Every report listed or known, with its ``fate``, and where to read those to be read."""
        known = before.select(
            F.col(REPORT).alias("k_report"), F.col("bytes").alias("k_bytes"), F.col("modified").alias("k_modified"),
            F.col("digest").alias("k_digest"), F.col(LOAD).alias("k_load"),
        )
        listed = self._listed(folder, glob).join(known, F.col(REPORT) == F.col("k_report"), "full")
        same = (F.col("bytes") == F.col("k_bytes")) & (F.col("modified") == F.col("k_modified"))
        listed = listed.withColumn(
            _FATE, F.when(F.col(REPORT).isNull(), "gone").when(F.coalesce(same, F.lit(False)), "unchanged")
        )
        listed = staged(listed, "listing")
        suspects = listed.where(f"{_FATE} is null")
        # Names come to the driver only if some of the folder is known; the file index there has them anyway.
        places: str | list[str] = folder
        if not listed.where(f"{_FATE} = 'unchanged'").isEmpty():
            places = [r[0] for r in suspects.select(REPORT).collect()]
        if not places:
            return listed.withColumn("digest", F.lit(None).cast("string")), places
        digests = staged(self._digests(places, glob, suspects), "digests")
        compared = listed.join(digests, REPORT, "left").withColumn(
            _FATE,
            F.coalesce(
                F.col(_FATE),
                F.when(F.col("k_report").isNull(), "new").when(F.col("digest").eqNullSafe(F.col("k_digest")), "touched"),
                F.lit("changed"),
            ),
        )
        return compared, places

    def load(self, source: str, glob: str, run: str, scan: Scan, keep_missing: bool = False) -> Loaded:
        """Bring the table up to date with the reports in ``source``.

        ``scan`` reads paths into rows with the ``file`` each comes from.
        """
        base = newest_version(self.spark, self._manifests)
        compared, places = self._compared(source, glob, self.manifest())
        compared = staged(compared, "compared")
        fates = {r[_FATE]: r["count"] for r in compared.groupBy(_FATE).count().collect()}
        if keep_missing:
            fates.pop("gone", None)
        found = Loaded(**fates)
        if not found.committed:
            return found
        load = uuid.uuid4().hex
        read = compared.where(F.col(_FATE).isin("new", "changed"))
        if found.new or found.changed:
            if not isinstance(places, str):
                places = [r[0] for r in read.select(REPORT).collect()]
            rows = scan(self.spark, places).withColumn("__report", report_path(F.col(FILE)))
            rows = rows.join(read.select(F.col(REPORT).alias("__report")), "__report", "left_semi")
            rows.drop("__report").write.parquet(f"{self.folder}/{LOAD}={load}")
        is_read = F.col(_FATE).isin("new", "changed")
        entry = compared.where(F.lit(keep_missing) | (F.col(_FATE) != "gone")).select(
            F.coalesce(REPORT, "k_report").alias(REPORT),
            F.coalesce("bytes", "k_bytes").alias("bytes"),
            F.coalesce("modified", "k_modified").alias("modified"),
            F.coalesce("digest", "k_digest").alias("digest"),
            F.when(is_read, F.lit(load)).otherwise(F.col("k_load")).alias(LOAD),
        )
        self._commit(entry, run, load, base)
        return found

    def _commit(self, manifest: DataFrame, run: str, load: str, base: int) -> None:
        try:
            write_snapshot(manifest, self._manifests, run, base=base)
        except Exception:
            CommitLog(self.spark, self.folder).delete_data(f"{LOAD}={load}")
            raise

    def compact(self, run: str) -> None:
        """Write all live rows as one load, so that readers open one folder again."""
        base = newest_version(self.spark, self._manifests)
        manifest = self.manifest()
        if manifest.isEmpty():
            return
        load = uuid.uuid4().hex
        self.table().write.parquet(f"{self.folder}/{LOAD}={load}")
        self._commit(manifest.withColumn(LOAD, F.lit(load)), run, load, base)

    def expire(self, keep: int, keep_seconds: float) -> list[str]:
        """Delete old manifests by the rule of snapshots, and loads that no manifest left names."""
        expire_snapshots(self.spark, self._manifests, keep, keep_seconds)
        log, loads = CommitLog(self.spark, self._manifests), CommitLog(self.spark, self.folder)
        oldest = CommitLog.now() - keep_seconds * 1000
        found = {n: t for n, t in loads.folders().items() if n.startswith(f"{LOAD}=") and t < oldest}
        parts = [f"{self._manifests}/{log.read(n).data}" for n in log.numbers()]
        named = self.spark.read.parquet(*parts).select(LOAD).distinct() if parts else None
        live = {f"{LOAD}={r[0]}" for r in named.collect()} if named is not None else set()
        gone = [n for n in found if n not in live]
        for name in gone:
            loads.delete_data(name)
        return gone
