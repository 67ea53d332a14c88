"""Sketches of key columns, kept beside each snapshot: distinct counts and overlaps without the tables.

A theta sketch holds the smallest hashes of a column's values, ``1 << SKETCH_BITS`` at most.
Sketches of any snapshots of any tables can be put together or intersected afterwards. The
relative standard error of a distinct count is 1 over the root of that number, that of an
overlap larger by the root of union over overlap. The exact distinct count stands beside each
sketch, taken in the same pass over the written data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.functions import text as t
from balcao.sources.commits import Commit, CommitLog
from balcao.sources.snapshots import NoSnapshot

SKETCH_BITS = 14
_SCHEMA = "key string, rows bigint, exact bigint, sketch binary"


def standard_error() -> float:
    return (1 << SKETCH_BITS) ** -0.5


def _place(folder: str, commit: Commit) -> str:
    return f"{folder}/_sketches/{commit.number}"


def _newest_filled(spark: SparkSession, folder: str) -> Commit:
    log = CommitLog(spark, folder)
    for number in log.numbers():
        commit = log.read(number)
        if commit.rows:
            return commit
    raise NoSnapshot(f"no snapshot with rows in {folder}")


def key_sketches(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """``key``, ``rows`` with a value, ``exact`` distinct values and their ``sketch``.

    Values are counted per (key, value) first, so a value with a third of all rows is one row
    when the sketch takes it in.
    """
    pairs = [F.struct(F.lit(n).alias("key"), t.blank_to_null(c.cast("string")).alias("value")) for n, c in keys.items()]
    cells = df.select(F.inline(F.array(*pairs))).where("value is not null")
    values = cells.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("key").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("exact"),
        F.theta_sketch_agg("value", SKETCH_BITS).alias("sketch"),
    )


def store_sketches(spark: SparkSession, folder: str, keys: Mapping[str, Column]) -> None:
    """Take the sketches of the newest filled snapshot's ``keys`` and keep them beside it."""
    commit = _newest_filled(spark, folder)
    sketches = key_sketches(spark.read.parquet(f"{folder}/{commit.data}"), keys)
    sketches.write.mode("overwrite").parquet(_place(folder, commit))


def stored_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """A few small rows; the table itself is not opened."""
    return spark.read.schema(_SCHEMA).parquet(_place(folder, _newest_filled(spark, folder)))


def estimates(sketches: DataFrame) -> DataFrame:
    """``key``, ``rows``, ``exact`` and the distinct count as ``estimated`` from the sketch."""
    return sketches.select("key", "rows", "exact", F.theta_sketch_estimate("sketch").alias("estimated"))


def overlap(one: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """``left``, ``right``, ``both`` and ``either``: distinct values of two sketched columns, as estimated."""
    a = one.where(F.col("key") == key).select(F.lit(0).alias("side"), F.col("sketch"))
    b = other.where(F.col("key") == other_key).select(F.lit(1).alias("side"), F.col("sketch"))
    sides = a.unionByName(b).agg(
        F.max_by("sketch", -F.col("side")).alias("a"), F.max_by("sketch", "side").alias("b"), F.count(F.lit(1)).alias("n")
    )
    return sides.where("n = 2").select(
        F.theta_sketch_estimate("a").alias("left"),
        F.theta_sketch_estimate("b").alias("right"),
        F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("both"),
        F.theta_sketch_estimate(F.theta_union("a", "b", F.lit(SKETCH_BITS))).alias("either"),
    )
