"""Branch scorecard: five rewards per branch and their sum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions.money import round2, sum_money
from balcao.operators import dated_rules

REWARDS = ("revenue_reward", "cost_reward", "hb_reward", "ticket_reward", "commission_reward")


def first_per_branch(table: DataFrame) -> DataFrame:
    """The first row of each branch by ``row_idx``, without gathering a branch's rows."""
    values = [c for c in table.columns if c not in ("branch_key", "row_idx")]
    first = table.groupBy("branch_key").agg(F.min(F.struct("row_idx", *values)).alias("first"))
    return first.select("branch_key", *[F.col(f"first.{c}").alias(c) for c in values])


def percent_reward(actual: Column, target: Column, steps: Sequence[tuple[int, float]]) -> Column:
    """The best step whose percent of target is reached; null without a positive target."""
    percent = percent_of(actual, target)
    return F.coalesce(*[F.when(percent >= step, F.lit(amount)) for step, amount in steps])


def percent_of(actual: Column, target: Column) -> Column:
    """Percent of a positive target."""
    return F.when(target > 0, F.try_divide(actual, target) * 100)


def cost_points(cost: Column, revenue: Column, target: Column) -> Column:
    """Cost points over target. None without revenue, unless cost is negative."""
    return F.when(revenue != 0, round2(F.try_divide(cost, revenue) * 100 - target)).when(
        (revenue == 0) & (cost < 0) & target.isNotNull(), F.lit(float("-inf"))
    )


def cost_reward(cost: Column, revenue: Column, target: Column) -> Column:
    """Reward for cost points at or under target. No revenue pays nothing, unless cost is negative."""
    points = cost_points(cost, revenue, target)
    return F.coalesce(*[F.when(points <= step, F.lit(amount)) for step, amount in vocab.COST_STEPS])


def commission_reward(commission: Column, revenue: Column, target: Column) -> Column:
    """A tenth of the branch's commission on target, a twentieth below.

    A zero target counts as reached by any positive revenue.
    """
    on_target = F.when(target == 0, revenue > 0).otherwise(
        F.try_divide(revenue, target) * 100 >= 100
    )
    rate = F.when(on_target, vocab.COMMISSION_SHARE_ON_TARGET).otherwise(
        vocab.COMMISSION_SHARE_BELOW_TARGET
    )
    known = revenue.isNotNull() & target.isNotNull()
    return F.when(known, round2(commission * rate))


def add_branch_commission(branches: DataFrame, commissions: DataFrame) -> DataFrame:
    """``commission`` of the branch key as it is, else of its two-digit form.

    Null where neither has rows; zero where rows exist but none is readable.
    """
    per_key = commissions.groupBy("branch_key").agg(
        F.coalesce(sum_money(F.col("amount")), F.lit(0.0)).alias("commission")
    )
    exact = per_key.select(
        F.col("branch_key").alias("exact_key"), F.col("commission").alias("exact_commission")
    )
    padded = per_key.select(
        F.col("branch_key").alias("padded_key"), F.col("commission").alias("padded_commission")
    )
    number = F.when(F.col("branch_key").rlike("^[0-9]$"), F.lpad("branch_key", 2, "0"))
    return (
        branches.join(exact, F.col("branch_key") == F.col("exact_key"), "left")
        .join(padded, number == F.col("padded_key"), "left")
        .withColumn("commission", F.coalesce("exact_commission", "padded_commission"))
        .drop("exact_key", "exact_commission", "padded_key", "padded_commission")
    )


def rewards_by_rules(branches: DataFrame, rules: DataFrame, day: str | Column) -> DataFrame:
    """The five rewards by the rules that hold on ``day`` (``dated_rules.py``)."""
    c = F.col
    # A zero target counts as reached by any positive revenue.
    reached = F.when(
        c("revenue_target") == 0, F.when(c("revenue") > 0, float("inf")).otherwise(F.lit(dated_rules.LOWEST))
    ).otherwise(F.try_divide("revenue", "revenue_target") * 100)
    wanted = [
        (dated_rules.REVENUE, percent_of(c("revenue"), c("revenue_target")), "revenue_reward"),
        (dated_rules.COST, -cost_points(c("cost"), c("revenue"), c("cost_target")), "cost_reward"),
        (dated_rules.REVENUE, percent_of(c("hb"), c("hb_target")), "hb_reward"),
        (dated_rules.TICKET, percent_of(c("ticket"), c("ticket_target")), "ticket_reward"),
        (dated_rules.COMMISSION_SHARE, reached, "__share"),
    ]
    paid = dated_rules.add_amounts(branches, rules, wanted, day)
    return paid.withColumn("commission_reward", round2(c("commission") * c("__share"))).select("branch_key", *REWARDS)


def build_scorecard(
    sales: DataFrame,
    targets: DataFrame,
    commissions: DataFrame,
    rules: DataFrame | None = None,
    day: str | Column | None = None,
) -> DataFrame:
    """One row per branch with sales: ``branch_key`` and the five rewards (null: not earned).

    ``rules`` takes steps and shares from rows that hold on ``day`` in place of today's.
    """
    joined = first_per_branch(sales).join(first_per_branch(targets), "branch_key", "left")
    branches = add_branch_commission(joined, commissions)
    if rules is not None:
        return rewards_by_rules(branches, rules, day)
    return branches.select(
        "branch_key",
        percent_reward(F.col("revenue"), F.col("revenue_target"), vocab.REVENUE_STEPS).alias(
            "revenue_reward"
        ),
        cost_reward(F.col("cost"), F.col("revenue"), F.col("cost_target")).alias("cost_reward"),
        percent_reward(F.col("hb"), F.col("hb_target"), vocab.REVENUE_STEPS).alias("hb_reward"),
        percent_reward(F.col("ticket"), F.col("ticket_target"), vocab.TICKET_STEPS).alias(
            "ticket_reward"
        ),
        commission_reward(F.col("commission"), F.col("revenue"), F.col("revenue_target")).alias(
            "commission_reward"
        ),
    )


def total_reward() -> Column:
    """Sum of the five rewards, missing ones counting zero."""
    return sum((F.coalesce(c, F.lit(0.0)) for c in REWARDS[1:]), F.coalesce(REWARDS[0], F.lit(0.0)))


def branch_rewards(scorecard: DataFrame) -> DataFrame:
    """``branch_key``, ``reward``: sum of the five rewards."""
    return scorecard.select("branch_key", total_reward().alias("reward"))
