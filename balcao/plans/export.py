"""Result tables the way users read them: Portuguese headings, Brazilian text, blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as t


def _shown(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def br_numbers(df: DataFrame) -> DataFrame:
    """Amounts as Brazilian text, so that the text tables read back what was meant."""
    return df.withColumns(
        {c: t.br_text(F.col(f"`{c}`")) for c, kind in df.dtypes if kind == "double"}
    )


def _money(name: str) -> Column:
    return _shown(t.br_text(F.col(name)))


def calc_view(calc: DataFrame) -> DataFrame:
    """The calc table, unordered. The target keeps the text the user typed."""
    values = (
        F.col("id"),
        F.col("branch").cast("string"),
        F.col("code").cast("string"),
        _shown(F.col("name")),
        _shown(F.col("target_text")),
        _money("achieved"),
        _money("achieved_app"),
        _shown(t.percent_text(F.col("progress"))),
        F.col("role"),
        _money("accrued"),
        _money("paid"),
        _money("bonus"),
        _money("total"),
    )
    return calc.select(*[v.alias(n) for v, n in zip(values, vocab.CALC_COLUMNS, strict=True)])


def in_branch_order(view: DataFrame) -> DataFrame:
    """Sorted by branch number, then name."""
    return view.orderBy(F.col("Filial").cast("bigint"), "Colaborador")


def scorecard_view(scorecard: DataFrame) -> DataFrame:
    """The scorecard table, unordered."""
    values = (
        F.col("branch_key"),
        _money("revenue_reward"),
        _money("cost_reward"),
        _money("hb_reward"),
        _money("ticket_reward"),
        _money("commission_reward"),
    )
    return scorecard.select(
        *[v.alias(n) for v, n in zip(values, vocab.SCORECARD_COLUMNS, strict=True)]
    )


def in_branch_text_order(view: DataFrame) -> DataFrame:
    """Sorted by branch as text, so ``10`` comes before ``2``."""
    return view.orderBy("Filial")


def people_view(people: DataFrame) -> DataFrame:
    """Matched people; missing cells blank."""
    columns = ("branch", "code", "cpf", "name", "title")
    return people.select(
        *[
            _shown(F.col(c).cast("string")).alias(n)
            for c, n in zip(columns, vocab.PEOPLE_COLUMNS, strict=True)
        ]
    )
