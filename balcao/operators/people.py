"""Who sells where: HR staff matched with point-of-sale staff on tax id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.functions import tax_ids
from balcao.functions import text as t
from balcao.sources.columns import pick_columns


CHECKED = "checked"  # zeros are restored where the check digits confirm them


def _cleaned(cpf: Column, pad: bool | str) -> Column:
    return tax_ids.repaired(cpf)["id"] if pad == CHECKED else t.tax_id(cpf, bool(pad))


def hr_rows(hr: DataFrame, pad: bool | str = False) -> DataFrame:
    """Branch, tax id and job title, whatever the columns are called exactly."""
    picked = pick_columns(
        hr, {"branch": ["filial"], "cpf": ["cpf"], "title": ["cargo atual", "cargo"]}, "HR staff"
    )
    return picked.withColumn("cpf", _cleaned(F.col("cpf").cast("string"), pad))


def hr_side(hr: DataFrame, pad: bool | str = False) -> DataFrame:
    return hr_rows(hr, pad).where(F.col("cpf") != "")


def pos_rows(pos: DataFrame, pad: bool | str = False) -> DataFrame:
    picked = pick_columns(
        pos,
        {
            "code": ["código", "codigo"],
            "cpf": ["cpf"],
            "name": ["funcionário", "funcionario", "nome"],
        },
        "point-of-sale staff",
    )
    return picked.withColumn("cpf", _cleaned(F.col("cpf").cast("string"), pad))


def pos_side(pos: DataFrame, pad: bool | str = False) -> DataFrame:
    return pos_rows(pos, pad).where(F.col("cpf") != "")


def repaired_tax_ids(df: DataFrame, column: str = "cpf") -> DataFrame:
    """``df`` with tax ids whose lost zeros the check digits confirm, and what became of each.

    Adds ``<column>_state``: valid, padded, unrepairable or missing.
    """
    found = tax_ids.repaired(F.col(f"`{column}`").cast("string"))
    return (
        df.withColumn("__repaired", found)
        .withColumns({column: F.col("__repaired.id"), f"{column}_state": F.col("__repaired.state")})
        .drop("__repaired")
    )


def match_people(hr: DataFrame, pos: DataFrame, pad: bool | str = False) -> DataFrame:
    """One row per pair with the same tax id; duplicates on a side pair up with each other.

    ``pad`` restores leading zeros of short ids: all of them, or the ``CHECKED`` ones.
    """
    pairs = hr_side(hr, pad).join(pos_side(pos, pad), "cpf")
    return pairs.where(F.col("branch").isNotNull() & F.col("code").isNotNull()).select(
        "branch", "code", "cpf", "name", "title"
    )


def people_order() -> list:
    """Branch, then code, as numbers; what is no number goes last."""
    return [
        F.asc_nulls_last(t.to_number(F.col("branch").cast("string"))),
        F.asc_nulls_last(t.to_number(F.col("code").cast("string"))),
    ]


def match_stats(hr: DataFrame, pos: DataFrame, pad: bool | str = False) -> DataFrame:
    """Distinct tax ids on each side and on both, in one pass."""
    sides = (
        hr_side(hr, pad)
        .select("cpf", F.lit(1).alias("hr"), F.lit(0).alias("pos"))
        .unionByName(pos_side(pos, pad).select("cpf", F.lit(0).alias("hr"), F.lit(1).alias("pos")))
    )
    ids = sides.groupBy("cpf").agg(F.max("hr").alias("hr"), F.max("pos").alias("pos"))
    return ids.agg(
        F.coalesce(F.sum("hr"), F.lit(0)).alias("hr_ids"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("pos_ids"),
        F.coalesce(F.sum(F.col("hr") * F.col("pos")), F.lit(0)).alias("common_ids"),
    )


def profile(df: DataFrame, order: list[str]) -> DataFrame:
    """Per column: filled cells, distinct values, and the value of the first row by ``order``.

    Values are counted per (column, value) before they are counted per column, so no
    column's values meet in one task.
    """
    position = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in df.columns
    ]
    cells = df.select(position.alias("at"), F.inline(F.array(*pairs)))
    values = cells.groupBy("column", "value").agg(
        F.count("value").alias("filled"), F.min("at").alias("at")
    )
    return values.groupBy("column").agg(
        F.sum("filled").alias("non_null"),
        F.count("value").alias("distinct_values"),
        F.min_by("value", "at").alias("sample"),
    )
