"""Attainment and what it pays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import period
from balcao.functions.money import round2, sum_money
from balcao.operators import dated_rules
from balcao.operators.roster import is_manager


def has_target(target: Column) -> Column:
    """A target of zero is no target."""
    return F.coalesce(target != 0, F.lit(False))


def attained(basis: Column, target: Column) -> Column:
    """Achieved over target, nothing achieved counting as zero; null without a target."""
    return F.when(has_target(target), F.try_divide(F.coalesce(basis, F.lit(0.0)), target))


def add_progress(roster: DataFrame, basis: str = "achieved_app") -> DataFrame:
    """``progress``: percent of target, 2 decimals."""
    percent = attained(F.col(basis), F.col("target")) * 100
    return roster.withColumn("progress", round2(percent))


def commission_per_code(commissions: DataFrame) -> DataFrame:
    """``commission`` per code. A zero total means there is no commission."""
    total = sum_money(F.coalesce("amount", F.lit(0.0)))
    return commissions.groupBy("code_key").agg(
        round2(F.nullif(total, F.lit(0.0))).alias("commission")
    )


def paid_commission(commission: Column, ratio: Column) -> Column:
    """Half of the commission below the threshold, all of it from there on."""
    return F.when(ratio < vocab.HALF_PAY_BELOW, commission * 0.5).otherwise(commission)


def bonus_for(ratio: Column) -> Column:
    """The best bonus step reached; null below the first."""
    return F.coalesce(*[F.when(ratio >= step, F.lit(amount)) for step, amount in vocab.BONUS_STEPS])


def flag_trainees(roster: DataFrame, trainees: DataFrame) -> DataFrame:
    ids = trainees.select(F.col("id").alias("trainee_id")).distinct()
    flagged = roster.join(ids, F.col("id") == F.col("trainee_id"), "left")
    return flagged.withColumn("is_trainee", F.col("trainee_id").isNotNull()).drop("trainee_id")


def add_payout(
    roster: DataFrame,
    commissions: DataFrame,
    trainees: DataFrame,
    basis: str = "achieved_app",
    rules: DataFrame | None = None,
    day: str | Column | None = None,
) -> DataFrame:
    """``accrued``, ``paid``, ``bonus``, ``total`` from each person's commission.

    Accrued is shown for everyone. Managers who are not trainees get nothing else here;
    nor does anyone without a target or a commission. The total is rounded from the
    unrounded paid amount. Keeps ``is_trainee`` for later steps. ``rules`` takes the steps
    from rows that hold on ``day`` (``dated_rules.py``) in place of today's.
    """
    totals = commission_per_code(commissions).select(
        F.col("code_key").alias("commission_code"), "commission"
    )
    joined = flag_trainees(roster, trainees).join(
        totals, F.col("code").cast("string") == F.col("commission_code"), "left"
    )
    ratio = attained(F.col(basis), F.col("target"))
    from_commission = (
        (~is_manager(F.col("role")) | F.col("is_trainee"))
        & ratio.isNotNull()
        & F.col("commission").isNotNull()
    )
    if rules is None:
        paid, bonus = paid_commission(F.col("commission"), ratio), bonus_for(ratio)
    else:
        wanted = [(dated_rules.PAY, ratio, "__share"), (dated_rules.BONUS, ratio, "__bonus")]
        joined = dated_rules.add_amounts(joined, rules, wanted, day)
        paid, bonus = F.col("commission") * F.col("__share"), F.col("__bonus")
    return joined.withColumns(
        {
            "accrued": F.col("commission"),
            "paid": F.when(from_commission, round2(paid)),
            "bonus": F.when(from_commission, bonus),
            "total": F.when(from_commission, round2(paid + F.coalesce(bonus, F.lit(0.0)))),
        }
    ).drop("commission_code", "commission", "__share", "__bonus")


def apply_scorecard(roster: DataFrame, rewards: DataFrame) -> DataFrame:
    """Pay managers from the branch scorecard and add it to what trainees earned.

    ``rewards`` has one row per branch: ``branch_key``, ``reward``. Branches without a
    scorecard change nothing.
    """
    joined = roster.join(
        rewards.select(F.col("branch_key").alias("reward_branch"), "reward"),
        F.col("branch").cast("string") == F.col("reward_branch"),
        "left",
    )
    has_reward = F.col("reward").isNotNull()
    managed = has_reward & is_manager(F.col("role")) & ~F.col("is_trainee")
    trained = has_reward & F.col("is_trainee")
    total = (
        F.when(managed, round2(F.col("reward")))
        .when(trained, round2(F.coalesce("total", F.lit(0.0)) + F.col("reward")))
        .otherwise(F.col("total"))
    )
    cleared = {c: F.when(~managed, F.col(c)) for c in ("accrued", "paid", "bonus")}
    return joined.withColumns({"total": total, **cleared}).drop("reward_branch", "reward")


def add_remaining(roster: DataFrame) -> DataFrame:
    """``remaining``: target minus achieved; null without a target."""
    left = F.col("target") - F.coalesce("achieved", F.lit(0.0))
    return roster.withColumn("remaining", left)


def add_daily_recommended(roster: DataFrame, as_of: dt.date | str | Column) -> DataFrame:
    """``daily_recommended``: what is missing per remaining day; null once achieved."""
    left = F.col("target") - F.coalesce("achieved", F.lit(0.0))
    wanted = has_target(F.col("target")) & (left > 0)
    return roster.withColumn(
        "daily_recommended", F.when(wanted, round2(left / period.days_left(as_of)))
    )


def add_single_payout(roster: DataFrame, commissions: DataFrame) -> DataFrame:
    """``payout``: one figure from each commission row of the same branch and code.

    A person with several commission rows appears once per row. Commission branches must
    be whole numbers; leading zeros do not matter.
    """
    keyed = commissions.select(
        F.col("branch_key").cast("bigint").alias("commission_branch"),
        F.col("code_key").alias("commission_code"),
        F.col("amount").alias("commission"),
    )
    joined = roster.join(
        keyed,
        (F.col("branch") == F.col("commission_branch"))
        & (F.col("code").cast("string") == F.col("commission_code")),
        "left",
    )
    ratio = attained(F.col("achieved"), F.col("target"))
    amount = paid_commission(F.col("commission"), ratio) + F.coalesce(bonus_for(ratio), F.lit(0.0))
    return joined.withColumn("payout", F.when(ratio.isNotNull(), round2(amount))).drop(
        "commission_branch", "commission_code"
    )
