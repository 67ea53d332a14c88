"""Output tables as snapshots, with the order of their rows.

A run never overwrites what it reads: each run adds a snapshot, and the newest one is the
previous state of the next run. The commit log (``commits.py``) beside the snapshots decides
which ones exist: a snapshot is written whole into a folder of its own and then committed as
the version after the one its writer started from. Of two writers with the same base one gets
``LostRace`` and its data is deleted. Names are only text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from balcao.operators.ordered import ROW
from balcao.sources.columns import in_order
from balcao.sources.commits import Commit, CommitLog, LostRace

SNAPSHOT = "snapshot"
KEEP = 24  # filled snapshots
KEEP_SECONDS = 7 * 24 * 3600  # nothing younger is deleted: someone may be reading it


class EmptyOutput(ValueError):
    """Raised where an empty result must not replace a table."""


def newest_version(spark: SparkSession, folder: str) -> int:
    """What a writer who reads the table now has to give as its ``base``; 0 before the first."""
    return CommitLog(spark, folder).newest()


def write_snapshot(
    df: DataFrame,
    folder: str,
    snapshot: str,
    columns: Sequence[str] | None = None,
    if_empty: str = "skip",
    base: int | None = None,
) -> bool:
    """Write ``df`` as the snapshot called ``snapshot``; returns whether it has rows.

    Rows are numbered in the order they come in (``row_idx``, unless ``df`` has one) and
    counted while they are written, so the result is computed once. Readers pass over a
    snapshot without rows, so an empty result replaces nothing; with ``if_empty="fail"`` it is
    an error as well. An existing snapshot is never changed. ``base`` is the version the result
    was computed from (the newest one at the call, if not given): if another writer has
    committed since, ``LostRace`` is raised and nothing is replaced.
    """
    if not re.fullmatch(r"[\w.+-]+", snapshot):
        raise ValueError(f"a snapshot's name has letters, digits and ._+- only: {snapshot!r}")
    log = CommitLog(df.sparkSession, folder)
    base = log.newest() if base is None else base
    if any(name.rsplit("~", 1)[0] == f"{SNAPSHOT}={snapshot}" for name in log.folders()):
        raise FileExistsError(f"snapshot {snapshot} already exists in {folder}")
    out = in_order(df, [*columns, *[ROW] * (ROW in df.columns)]) if columns else df
    if ROW not in out.columns:
        out = out.withColumn(ROW, F.monotonically_increasing_id())
    counted = Observation("written")
    data = f"{SNAPSHOT}={snapshot}~{uuid.uuid4().hex}"
    out.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{data}")
    rows = counted.get["rows"]
    try:
        log.claim(Commit(base + 1, snapshot, rows, log.now(), data))
    except LostRace:
        log.delete_data(data)
        raise
    if rows == 0 and if_empty == "fail":
        raise EmptyOutput(f"nothing to write to {folder}")
    return rows > 0


class NoSnapshot(FileNotFoundError):
    """Raised where a table has never been written."""


def latest_snapshot(
    spark: SparkSession, folder: str, even_if_empty: bool = False, with_order: bool = False
) -> DataFrame:
    """The snapshot with rows that was committed last.

    ``even_if_empty`` takes the last one as it is: its table may have become empty.
    ``with_order`` keeps the rows' numbers.
    """
    log = CommitLog(spark, folder)
    newest = None
    for number in log.numbers():
        commit = log.read(number)
        newest = newest or commit
        if commit.rows or even_if_empty:
            newest = commit
            break
    if newest is None:
        raise NoSnapshot(f"no snapshot in {folder}")
    # Without a filled snapshot the last empty one shows the table's columns.
    table = spark.read.parquet(f"{folder}/{newest.data}")
    return table if with_order else table.drop(ROW)


def expire_snapshots(
    spark: SparkSession, folder: str, keep: int = KEEP, keep_seconds: float = KEEP_SECONDS
) -> list[str]:
    """Delete what the rule does not keep; returns the names of the folders deleted.

    Kept are the newest version, the newest ``keep`` filled ones and all that were committed
    within ``keep_seconds``. Data that no commit names (of writers that failed) goes as well,
    once it is as old. An expired commit goes before its data, so that no reader starts on it.
    """
    log = CommitLog(spark, folder)
    oldest = log.now() - keep_seconds * 1000
    found = log.folders()  # before the commits: what is committed meanwhile is not taken for a leftover
    commits = [log.read(number) for number in log.numbers()]
    filled = [c.number for c in commits if c.rows][:keep]
    expired = [c for c in commits[1:] if c.number not in filled and c.written < oldest]
    named = {c.data for c in commits}
    left = [n for n, changed in found.items() if n.startswith(f"{SNAPSHOT}=") and n not in named and changed < oldest]
    for commit in expired:
        log.forget(commit.number)
    gone = [c.data for c in expired] + left
    for name in gone:
        log.delete_data(name)
    return gone


def blank_missing(df: DataFrame) -> DataFrame:
    """Null, NaN and infinity as blank text, in every column."""
    types = dict(df.dtypes)

    def shown(name: str):
        value = F.col(f"`{name}`")
        if types[name] in ("double", "float"):
            value = F.when(F.abs(value) < float("inf"), value)
        return F.coalesce(value.cast("string"), F.lit("")).alias(name)

    return df.select(*[shown(name) for name in df.columns])
