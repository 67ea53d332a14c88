"""The list of people a month is calculated for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as t


def is_manager(role: Column) -> Column:
    return F.coalesce(t.upper_name(role).isin(*vocab.MANAGER_ROLES), F.lit(False))


def build_roster(people: DataFrame) -> DataFrame:
    """Matched people in a commissioned role: ``id``, ``branch``, ``code``, ``name``, ``role``.

    A branch or code that is not a whole number fails the job.
    """
    branch = t.branch_number(F.col("branch").cast("string"))
    code = t.code_number(F.col("code").cast("string"))
    typed = people.select(
        branch.alias("branch"),
        code.alias("code"),
        "name",
        t.role_of(F.col("title")).alias("role"),
    )
    kept = typed.where(F.col("role").isin(*vocab.COMMISSIONED_ROLES))
    return kept.select(t.person_id(F.col("branch"), F.col("code")).alias("id"), *typed.columns)


def id_collisions(roster: DataFrame) -> DataFrame:
    """Ids that stand for more than one (branch, code)."""
    pairs = roster.select("id", "branch", "code").distinct()
    counted = pairs.groupBy("id").agg(
        F.count("*").alias("people"),
        F.min("branch").alias("lowest_branch"),
        F.max("branch").alias("highest_branch"),
    )
    return counted.where(F.col("people") > 1)


def missing_second_targets(roster: DataFrame, second: DataFrame) -> DataFrame:
    """Second-target rows whose id is not on the roster yet."""
    return second.join(roster.select("id").distinct(), "id", "left_anti")


def add_second_targets(roster: DataFrame, second: DataFrame) -> DataFrame:
    """Give people with a target in a second branch a row there.

    The new row copies the person's first row by (branch, name). Rows already on the
    roster are not repeated; codes nobody on the roster has are left out.
    """
    others = [c for c in roster.columns if c not in ("branch", "name", "id")]
    first = roster.groupBy(F.col("code").cast("string").alias("code_key")).agg(
        F.min(F.struct("branch", "name", "id", *others)).alias("base")
    )
    columns = [c for c in roster.columns if c not in ("id", "branch")]
    added = missing_second_targets(roster, second).join(first, "code_key").select(
        "id",
        t.to_whole(F.col("branch"), "a branch number").alias("branch"),
        *[F.col(f"base.{c}").alias(c) for c in columns],
    )
    return roster.unionByName(added)


def drop_on_leave(roster: DataFrame, leave: DataFrame) -> DataFrame:
    """Remove people on leave, matched on branch text and upper-case name.

    The branch is compared as text: ``01`` on the leave list is not branch 1.
    """
    named = roster.withColumn("name", t.upper_name(F.col("name")))
    on_leave = (F.col("r.branch").cast("string") == F.col("l.branch")) & (
        F.col("r.name") == F.col("l.name")
    )
    return named.alias("r").join(leave.alias("l"), on_leave, "left_anti")


def drop_person(roster: DataFrame, name: str) -> DataFrame:
    return roster.where(~t.upper_name(F.col("name")).eqNullSafe(name.strip().upper()))


def carry_forward(roster: DataFrame, previous: DataFrame, name: str) -> DataFrame:
    """Bring a value of the previous output along by id: ``name`` and its text."""
    kept = previous.select("id", F.col("kept").alias(f"{name}_text"))
    joined = roster.join(kept, "id", "left")
    return joined.withColumn(name, t.br_to_double(F.col(f"{name}_text")))
