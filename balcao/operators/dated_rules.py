"""Tiers and rates kept as dated rows instead of constants.

A rule is (``kind``, ``valid_from``, ``valid_to``, ``at_least``, ``amount``): from its first to
its last day (null: open), a value of that kind of ``at_least`` or more earns ``amount``. The
days on which any rule starts or ends cut time into periods; the steps of one period fold into
one row. A fact knows its period from its day, meets the period's row in an equality join that
Spark sizes itself, and picks its step inside the row: no pair of fact and rule is ever made.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab

SCHEMA = "kind string, valid_from date, valid_to date, at_least double, amount double"
LOWEST = float("-inf")
PAY, BONUS, REVENUE, TICKET, COST, COMMISSION_SHARE = "pay", "bonus", "revenue", "ticket", "cost", "commission"


class OverlappingRules(ValueError):
    """Raised where two rules of one kind and step hold on one day."""


def todays_rules(spark: SparkSession, since: dt.date = dt.date(1900, 1, 1)) -> DataFrame:
    """The constants of the payout and the scorecard as rows.

    Cost counts the points saved, so that more is better as everywhere else.
    """
    steps: list[tuple[str, float, float]] = [
        (PAY, LOWEST, 0.5),
        (PAY, vocab.HALF_PAY_BELOW, 1.0),
        *[(BONUS, step, amount) for step, amount in vocab.BONUS_STEPS],
        *[(REVENUE, float(step), amount) for step, amount in vocab.REVENUE_STEPS],
        *[(TICKET, float(step), amount) for step, amount in vocab.TICKET_STEPS],
        *[(COST, float(-step), amount) for step, amount in vocab.COST_STEPS],
        (COMMISSION_SHARE, LOWEST, vocab.COMMISSION_SHARE_BELOW_TARGET),
        (COMMISSION_SHARE, 100.0, vocab.COMMISSION_SHARE_ON_TARGET),
    ]
    return spark.createDataFrame([(kind, since, None, at, amount) for kind, at, amount in steps], SCHEMA)


def overlaps(rules: DataFrame) -> DataFrame:
    """Rules of one kind and step that hold on a day on which an earlier one still does."""
    folded = rules.groupBy("kind", "at_least").agg(
        F.array_sort(F.collect_list(F.struct("valid_from", "valid_to"))).alias("spans")  # changes of one step
    )
    later = F.slice("spans", F.lit(2), F.greatest(F.size("spans") - 1, F.lit(0)))
    pairs = F.zip_with(F.slice("spans", F.lit(1), F.size(later)), later, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    bad = F.exists(pairs, lambda p: p["a"]["valid_to"].isNull() | (p["a"]["valid_to"] >= p["b"]["valid_from"]))
    return folded.where(bad).select("kind", "at_least")


def checked(rules: DataFrame) -> DataFrame:
    """``rules``, unless two of them contradict each other."""
    wrong = overlaps(rules).first()
    if wrong is not None:
        raise OverlappingRules(f"rules of {wrong.kind} from {wrong.at_least} on overlap in time")
    return rules


def _changes(rules: DataFrame) -> list[dt.date]:
    """Days on which the rules change: two for each rule at most."""
    starts = rules.select(F.col("valid_from").alias("day"))
    ends = rules.where("valid_to is not null").select(F.date_add("valid_to", 1).alias("day"))
    return sorted(r.day for r in starts.unionByName(ends).distinct().collect())


def _period(day: Column, changes: Sequence[dt.date]) -> Column:
    """How many changes a day has seen."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in changes]), lambda c: c <= day))


def add_amounts(
    df: DataFrame, rules: DataFrame, wanted: Sequence[tuple[str, str | Column, str]], day: str | Column
) -> DataFrame:
    """Add a column for each (kind, value, name) in ``wanted``: what the rules pay on ``day``.

    Of the steps that hold on the day the highest one reached counts; null where none is, or
    where the day or the value is null.
    """
    kinds = sorted({kind for kind, _, _ in wanted})
    steps = rules.where(F.col("kind").isin(kinds))
    changes = _changes(steps)
    if not changes:
        return df.withColumns({name: F.lit(None).cast("double") for _, _, name in wanted})
    last = F.when(F.col("valid_to").isNull(), F.lit(len(changes))).otherwise(_period(F.col("valid_to"), changes))
    spread = steps.withColumn("__period", F.explode(F.sequence(_period(F.col("valid_from"), changes), last)))
    # One row for each period, as many steps as the rules have.
    folded = spread.groupBy("__period").pivot("kind", kinds).agg(
        F.array_sort(F.collect_list(F.struct("at_least", "amount")))
    )
    folded = folded.toDF("__period", *[f"__steps_{kind}" for kind in kinds])
    at = F.col(day) if isinstance(day, str) else day
    joined = df.withColumn("__period", _period(at.cast("date"), changes)).join(folded, "__period", "left")

    def amount(kind: str, value: str | Column) -> Column:
        reached = F.col(value) if isinstance(value, str) else value
        earned = F.filter(f"__steps_{kind}", lambda step: step["at_least"] <= reached)
        return F.try_element_at(earned, F.lit(-1))["amount"]

    added = {name: amount(kind, value) for kind, value, name in wanted}
    return joined.withColumns(added).drop("__period", *[f"__steps_{kind}" for kind in kinds])
