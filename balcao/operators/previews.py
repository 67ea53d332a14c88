"""The first rows and values of a table, by a given order, without sorting it.

Ranks up to a small limit are kept inside every task first, so of each group only a few rows
travel; the groups' own first rows come from those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.functions import text as t
from balcao.operators.people import hr_side, pos_side


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group, with their ``position`` from 1."""
    ranked = df.withColumn("position", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("position") <= most)


def first_values(df: DataFrame, order: Sequence[str], most: int = 5) -> DataFrame:
    """``column``, ``position``, ``value``: the first filled values of every column by ``order``."""
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]
    cells = df.select(place.alias("at"), F.inline(F.array(*pairs))).where(t.blank_to_null(F.col("value")).isNotNull())
    return first_per_group(cells, ["column"], ["at", "value"], most).select("column", "position", "value")


def first_ids(hr: DataFrame, pos: DataFrame, most: int = 10, pad: bool = False) -> DataFrame:
    """``side``, ``position``, ``cpf``: the smallest distinct tax ids of HR, of the point of sale and of both.

    Each id counts once however often it is listed; the sides meet in one aggregate.
    """
    listed = hr_side(hr, pad).select("cpf", F.lit(True).alias("hr"), F.lit(False).alias("pos"))
    listed = listed.unionByName(pos_side(pos, pad).select("cpf", F.lit(False).alias("hr"), F.lit(True).alias("pos")))
    ids = listed.groupBy("cpf").agg(F.bool_or("hr").alias("hr"), F.bool_or("pos").alias("pos"))
    sides = F.array_compact(
        F.array(
            F.when(F.col("hr"), F.lit("hr")),
            F.when(F.col("pos"), F.lit("pos")),
            F.when(F.col("hr") & F.col("pos"), F.lit("both")),
        )
    )
    each = ids.select("cpf", F.explode(sides).alias("side"))
    return first_per_group(each, ["side"], ["cpf"], most).select("side", "position", "cpf")
