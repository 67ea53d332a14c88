"""Flat text tables, as users keep them, turned into typed tables.

Every table arrives all text with Portuguese headings and blanks for missing values.
Key rules differ per table on purpose: each is matched the way its consumer expects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as t
from balcao.operators.ordered import ROW
from balcao.sources.columns import optional, require, trimmed
from balcao.sources.records import scan_records


def read_tab(spark: SparkSession, path: str) -> DataFrame:
    """A delimited table as text with trimmed headings, its rows numbered (``row_idx``).

    The first record holds the headings; only that one comes to the driver. A file that ends
    inside a quoted cell is an error.
    """
    records, facts = scan_records(spark, path, "*")
    if not facts.where("is_open").isEmpty():
        raise ValueError(f"a quoted cell is never closed in {path}")
    head = records.orderBy(ROW).first()
    names = [str(name).strip() for name in head["cells"]] if head else []
    cells = [F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names) if name]
    filled = F.exists("cells", lambda c: t.strip(c) != "")
    return records.where((F.col(ROW) > (head[ROW] if head else 0)) & filled).select(*cells, ROW)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _ordered(tab: DataFrame, table: str) -> DataFrame:
    """The table, if it says in which order its rows stand."""
    return require(tab, (ROW,), table)


def seller_sales(tab: DataFrame) -> DataFrame:
    """VENDAS_VENDEDOR: ``branch_key``, ``code_key``, ``amount`` (unreadable is 0)."""
    tab = require(trimmed(tab), ("Filial", "Código", "Valor Vendas"), "VENDAS_VENDEDOR")
    return tab.select(
        t.branch_without_f(_col("Filial")).alias("branch_key"),
        t.code_key(_col("Código")).alias("code_key"),
        t.br_or_zero(_col("Valor Vendas")).alias("amount"),
    )


def channel_shares(tab: DataFrame | None, spark: SparkSession) -> DataFrame:
    """VENDAS_548: ``branch_key``, ``share``; rows without a share are left out."""
    tab = optional(tab, ("Filial", "40% VT"), spark)
    return tab.select(
        t.strip(_col("Filial")).alias("branch_key"), t.br_to_double(_col("40% VT")).alias("share")
    ).where(F.col("share").isNotNull())


def commissions(tab: DataFrame) -> DataFrame:
    """COMISSOES: ``branch_key`` with its zeros, ``code_key``, ``amount`` (null if unreadable)."""
    tab = require(trimmed(tab), ("Filial", "Código", "Valor Comissão"), "COMISSOES")
    return tab.select(
        t.branch_key(_col("Filial"), keep_zeros=True).alias("branch_key"),
        t.code_key(_col("Código")).alias("code_key"),
        t.br_to_double(_col("Valor Comissão")).alias("amount"),
    )


def branch_sales(tab: DataFrame) -> DataFrame:
    tab = _ordered(require(trimmed(tab), vocab.BRANCH_SALES_COLUMNS, "VENDAS_FILIAL"), "VENDAS_FILIAL")
    return tab.select(
        t.branch_key(_col("Filial")).alias("branch_key"),
        ROW,
        t.br_to_double(_col("Faturamento Total")).alias("revenue"),
        t.br_to_double(_col("Faturamento HB")).alias("hb"),
        t.br_to_double(_col("Custo Total")).alias("cost"),
        t.br_to_double(_col("Ticket Médio")).alias("ticket"),
    )


def branch_targets(tab: DataFrame) -> DataFrame:
    tab = _ordered(require(trimmed(tab), vocab.BRANCH_TARGET_COLUMNS, "META_FILIAL"), "META_FILIAL")
    return tab.select(
        t.branch_key(_col("Filial")).alias("branch_key"),
        ROW,
        t.br_to_double(_col("Number")).alias("revenue_target"),
        t.br_to_double(_col("HB")).alias("hb_target"),
        t.br_to_double(_col("TKT MÉDIO")).alias("ticket_target"),
        t.percent_to_double(_col("CMV")).alias("cost_target"),
    )


def trainees(tab: DataFrame | None, spark: SparkSession) -> DataFrame:
    """TRAINEES: distinct ``id``."""
    tab = optional(tab, vocab.PERSON_LIST_COLUMNS, spark)
    return tab.select(t.strip(_col("ID")).alias("id")).distinct()


def second_targets(tab: DataFrame | None, spark: SparkSession) -> DataFrame:
    """2_META: ``id``, ``branch`` (text), ``code_key``."""
    tab = optional(tab, vocab.PERSON_LIST_COLUMNS, spark)
    return tab.select(
        t.strip(_col("ID")).alias("id"),
        t.strip(_col("Filial")).alias("branch"),
        t.code_key(_col("Código")).alias("code_key"),
    )


def leave(tab: DataFrame | None, spark: SparkSession) -> DataFrame:
    """AFASTAMENTOS: distinct (``branch`` text, upper-case ``name``)."""
    tab = optional(tab, vocab.LEAVE_COLUMNS, spark)
    return tab.select(
        t.strip(_col("Filial")).alias("branch"), t.upper_name(_col("Colaborador")).alias("name")
    ).distinct()


def previous_values(tab: DataFrame | None, column: str, spark: SparkSession) -> DataFrame:
    """Last non-blank text per ``id`` of one column of the previous output."""
    tab = optional(tab, ("ID", column), spark)
    if tab.columns == ["ID", column]:  # absent: nothing to keep, in any order
        tab = tab.withColumn(ROW, F.lit(0).cast("bigint"))
    tab = _ordered(tab, "the previous output")
    known = tab.select(
        t.blank_to_null(_col("ID")).alias("id"),
        t.blank_to_null(_col(column)).alias("kept"),
        ROW,
    ).dropna(subset=["id", "kept"])
    return known.groupBy("id").agg(F.max(F.struct(ROW, "kept")).alias("last")).select(
        "id", F.col("last.kept").alias("kept")
    )
