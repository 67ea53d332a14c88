"""The month's calculation, from typed tables to payouts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao.operators import dated_rules, payout, roster, sales, scorecard
from balcao.operators.quarantine import MONTH_CHECKS, split, together
from balcao.sources import tabs
from balcao.sources.columns import trimmed
from balcao.sources.staging import staged


@dataclass(frozen=True)
class MonthTables:
    """Flat text tables as users keep them; the optional ones may be missing."""

    people: DataFrame
    seller_sales: DataFrame
    commissions: DataFrame
    branch_sales: DataFrame | None = None
    branch_targets: DataFrame | None = None
    channel_sales: DataFrame | None = None
    trainees: DataFrame | None = None
    second_targets: DataFrame | None = None
    leave: DataFrame | None = None
    previous: DataFrame | None = None


@dataclass(frozen=True)
class MonthResult:
    calc: DataFrame
    scorecard: DataFrame | None
    quarantine: DataFrame | None = None


def set_aside(tables: MonthTables, spark: SparkSession) -> tuple[MonthTables, DataFrame]:
    """The tables without the rows the calculation would fail on, and those rows."""
    places = {"people": "filtered_user", "second_targets": "2_META", "branch_targets": "META_FILIAL"}
    good, bad = {}, []
    for field, table in places.items():
        found = getattr(tables, field)
        if found is not None:
            good[field], faults = split(trimmed(found), table, MONTH_CHECKS[table])
            bad.append(faults)
    return replace(tables, **good), together(bad, spark)


def adjusted_roster(tables: MonthTables, second: DataFrame, spark: SparkSession) -> DataFrame:
    """Roster with second-branch rows added, people on leave removed and targets kept."""
    people = tables.people.select(*[f"`{c}`" for c in ("Filial", "Código", "Nome", "Cargo atual")])
    base = roster.build_roster(people.toDF("branch", "code", "name", "title"))
    present = roster.drop_on_leave(
        roster.add_second_targets(base, second), tabs.leave(tables.leave, spark)
    )
    previous = tabs.previous_values(tables.previous, "Meta", spark)
    return roster.carry_forward(present, previous, "target")


def month_scorecard(
    tables: MonthTables, commissions: DataFrame, rules: DataFrame | None = None, day: Column | None = None
) -> DataFrame | None:
    """The branch scorecard, or none if one of its tables is missing."""
    if tables.branch_sales is None or tables.branch_targets is None:
        return None
    return scorecard.build_scorecard(
        tabs.branch_sales(tables.branch_sales),
        tabs.branch_targets(tables.branch_targets),
        commissions,
        rules,
        day,
    )


def close_month(
    tables: MonthTables,
    spark: SparkSession,
    basis: str = "achieved_app",
    quarantine: bool = False,
    rules: DataFrame | None = None,
    as_of: dt.date | None = None,
) -> MonthResult:
    """Everything in order: roster, achieved, channel share, progress, payout, scorecard.

    ``basis`` is what progress and payout are measured on: ``achieved_app`` with the
    channel share, or plain ``achieved``. A key or percentage that cannot be read fails the
    job; with ``quarantine`` its row is set aside instead and the month goes on without it.
    ``rules`` has the steps and rates to pay by, of which those that hold on ``as_of`` count.
    """
    aside, day = None, None
    if rules is not None:
        if as_of is None:
            raise ValueError("dated rules need the day they are applied on")
        rules, day = dated_rules.checked(rules), F.lit(as_of)
    if quarantine:
        tables, aside = set_aside(tables, spark)
    commissions = tabs.commissions(tables.commissions)
    second = tabs.second_targets(tables.second_targets, spark)
    with_target = adjusted_roster(tables, second, spark)
    achieved = sales.add_achieved(with_target, tabs.seller_sales(tables.seller_sales), second)
    shares = tabs.channel_shares(tables.channel_sales, spark)
    credited = sales.add_channel_share(achieved, shares)
    measured = payout.add_progress(credited, basis)
    paid = payout.add_payout(measured, commissions, tabs.trainees(tables.trainees, spark), basis, rules, day)
    card = month_scorecard(tables, commissions, rules, day)
    if card is not None:
        # One small row for each branch, read by the payout and by whoever writes the card.
        card = staged(card, "scorecard")
        paid = payout.apply_scorecard(paid, scorecard.branch_rewards(card))
    return MonthResult(paid, card, aside)
