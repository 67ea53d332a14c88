"""Rows that cannot be used, set aside with the reason instead of failing the job.

A table goes through once: every row is written with its faults to the good or to the bad part
of one staged table, and both results read their own part only. What is left raises nothing
where keys and percentages are typed later.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.functions import text as t
from balcao.operators.ordered import ROW
from balcao.sources.columns import empty_text_table
from balcao.sources.staging import new_folder

COLUMNS = ("table", ROW, "column", "value", "reason", "row")
_BAD, _FAULTS, _AT = "__bad", "__faults", "__at"
_FAULT = "array<struct<column:string,value:string,reason:string>>"


@dataclass(frozen=True)
class Check:
    """``holds`` is true for every value of ``column`` that later steps can use."""

    column: str
    reason: str
    holds: Callable[[Column], Column]


BRANCH = Check("Filial", "not a branch number", t.is_branch_number)
CODE = Check("Código", "not a seller code", t.is_code_number)
COST_TARGET = Check("CMV", "not a percentage", t.is_percent)
# What would otherwise fail the month, by table. Branches of other tables are compared as text.
MONTH_CHECKS: dict[str, tuple[Check, ...]] = {
    "filtered_user": (BRANCH, CODE),
    "2_META": (Check("Filial", "not a branch number", t.is_whole),),
    "META_FILIAL": (COST_TARGET,),
}


class Split(NamedTuple):
    """``good`` has the table's columns, ``bad`` those of ``COLUMNS``, a row for each fault."""

    good: DataFrame
    bad: DataFrame


def split(df: DataFrame, table: str, checks: Sequence[Check]) -> Split:
    """Divide a table by its checks; checks of columns it lacks are passed over.

    Every row is in one of the two parts. A bad row is kept whole as JSON (``row``); its
    ``row_idx`` is the table's own, or a number given while it is written.
    """
    checks = [c for c in checks if c.column in df.columns]
    faults = F.array().cast(_FAULT)
    if checks:
        found = [
            F.when(
                ~F.coalesce(c.holds(F.col(f"`{c.column}`").cast("string")), F.lit(False)),
                F.struct(
                    F.lit(c.column).alias("column"),
                    F.col(f"`{c.column}`").cast("string").alias("value"),
                    F.lit(c.reason).alias("reason"),
                ),
            )
            for c in checks
        ]
        faults = F.filter(F.array(*found), lambda f: f.isNotNull()).cast(_FAULT)
    at = F.col(ROW) if ROW in df.columns else F.monotonically_increasing_id()
    marked = df.withColumns({_FAULTS: faults, _AT: at.cast("bigint")}).withColumn(_BAD, F.size(_FAULTS) > 0)
    path = new_folder(df.sparkSession, "quarantine")
    marked.write.partitionBy(_BAD).parquet(path)
    written = df.sparkSession.read.schema(marked.schema).parquet(path)
    names = [F.col(f"`{c}`") for c in df.columns]
    row = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    bad = written.where(F.col(_BAD)).select(
        F.lit(table).alias("table"), F.col(_AT).alias(ROW), F.inline(_FAULTS), row.alias("row")
    )
    return Split(written.where(~F.col(_BAD)).select(*names), bad.select(*COLUMNS))


def together(parts: Sequence[DataFrame], spark) -> DataFrame:
    """All faults of several tables."""
    none = empty_text_table(spark, COLUMNS).withColumn(ROW, F.col(ROW).cast("bigint"))
    return reduce(DataFrame.unionByName, parts, none)
