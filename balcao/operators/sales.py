"""Sales per person and branch, and what counts as achieved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from balcao.functions.money import round2, sum_money
from balcao.operators.roster import is_manager


def totals_per_branch_and_code(sales: DataFrame) -> DataFrame:
    """``branch_key``, ``code_key``, ``amount``: partial sums first, one shuffle."""
    return sales.groupBy("branch_key", "code_key").agg(sum_money(F.col("amount")).alias("amount"))


def totals_per_code(sales: DataFrame) -> DataFrame:
    return sales.groupBy("code_key").agg(sum_money(F.col("amount")).alias("amount"))


def totals_per_branch(sales: DataFrame, column: str = "amount") -> DataFrame:
    """Branches with nothing but missing values do not appear."""
    known = sales.where(F.col(column).isNotNull())
    return known.groupBy("branch_key").agg(sum_money(F.col(column)).alias(column))


def flag_two_branch_codes(roster: DataFrame, second: DataFrame) -> DataFrame:
    """``two_branches``: does anyone with this code have a target in a second branch?"""
    codes = second.select(F.col("code_key").alias("second_code")).distinct()
    same = F.col("code").cast("string") == F.col("second_code")
    flagged = roster.join(codes, same, "left")
    return flagged.withColumn("two_branches", F.col("second_code").isNotNull()).drop("second_code")


def add_achieved(roster: DataFrame, sales: DataFrame, second: DataFrame) -> DataFrame:
    """``achieved``: sales over all branches, or of the row's own branch for people with two.

    The fact is summed once per (branch, code); sums per code are taken from that. The
    sums meet the roster in the partitioning the summing left them in.
    """
    flagged = flag_two_branch_codes(roster, second)
    in_branch = totals_per_branch_and_code(sales)
    anywhere = totals_per_code(in_branch)
    own = in_branch.select(
        F.col("branch_key").alias("own_branch"),
        F.col("code_key").alias("own_code"),
        F.col("amount").alias("own_amount"),
    )
    total = anywhere.select(
        F.col("code_key").alias("total_code"), F.col("amount").alias("total_amount")
    )
    code = F.col("code").cast("string")
    joined = flagged.join(total, code == F.col("total_code"), "left").join(
        own,
        F.col("two_branches")
        & (code == F.col("own_code"))
        & (F.col("branch").cast("string") == F.col("own_branch")),
        "left",
    )
    achieved = F.when(F.col("two_branches"), F.col("own_amount")).otherwise(F.col("total_amount"))
    return joined.withColumn("achieved", round2(achieved)).drop(
        "total_code", "total_amount", "own_branch", "own_code", "own_amount", "two_branches"
    )


def add_channel_share(roster: DataFrame, shares: DataFrame) -> DataFrame:
    """``achieved_app``: achieved plus the branch's whole channel share, except for managers."""
    per_branch = totals_per_branch(shares, "share").select(
        F.col("branch_key").alias("share_branch"), "share"
    )
    joined = roster.join(
        per_branch, F.col("branch").cast("string") == F.col("share_branch"), "left"
    )
    credited = ~is_manager(F.col("role")) & F.col("share").isNotNull()
    with_share = round2(F.coalesce("achieved", F.lit(0.0)) + F.col("share"))
    return joined.withColumn(
        "achieved_app", F.when(credited, with_share).otherwise(F.col("achieved"))
    ).drop("share_branch", "share")
