"""What becomes of every row: kept, or dropped by which step and why.

Each report's rows below the header are staged once and judged in one frame, so what is kept
and what is dropped come from the same pass and add up to what was read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as t
from balcao.operators import people, reports
from balcao.operators.ordered import FILE, ROW, ROWS_PER_CHUNK
from balcao.sources.staging import staged

KEPT = "kept"
REASON = "reason"


def _with_rest(judged: DataFrame, lines: DataFrame, relevant: Column, reason: str) -> DataFrame:
    """Judged rows, and behind them the rows that were never looked at."""
    rest = lines.where(~relevant).select(FILE, ROW, F.lit(reason).alias(REASON))
    return judged.select(FILE, ROW, REASON).unionByName(rest)


def judged_sellers(report: DataFrame, header: str, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    lines = reports.seller_lines(report, vocab.HEADER_ROW[header])
    reason = F.when(reports.names_seller_branch(), "names a branch").when(
        ~t.is_digits(F.col("code")), "holds no seller code"
    )
    return lines.select(FILE, ROW, reason.alias(REASON))


def judged_commissions(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    lines = staged(reports.commission_lines(report), "lines")
    named = reports.names_commission_branch()
    reason = F.when(named, "names a branch").when(F.col("branch").isNull(), "stands under no branch")
    judged = reports.fill_commission_branches(lines, chunk_rows).withColumn(REASON, reason)
    return _with_rest(judged, lines, named | t.is_digits(F.col("código")), "holds no seller code")


def judged_channel(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    lines = reports.channel_lines(report)
    return lines.select(FILE, ROW, F.when(F.col("branch").isNull(), "names no branch").alias(REASON))


def judged_totals(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    lines = staged(reports.total_lines(report), "lines")
    is_branch, is_hb, is_total = reports.total_row_kinds()
    reason = (
        F.when(is_branch, "names a branch")
        .when(is_hb, "sales of a product group")
        .when(~F.col("counts"), "total under no branch")
    )
    judged = reports.judge_totals(lines, chunk_rows).withColumn(REASON, reason)
    return _with_rest(judged, lines, is_branch | is_hb | is_total, "belongs to no record")


def judged_pos_staff(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    reason = F.when(t.to_number(F.col("code")).isNull(), "code is no number").when(
        F.col("code").isin(*vocab.POS_DUMMY_CODES), "dummy code"
    )
    return reports.pos_staff_lines(report).select(FILE, ROW, reason.alias(REASON))


JUDGES: dict[str, Callable[..., DataFrame]] = {
    "sellers": lambda report, chunk_rows=ROWS_PER_CHUNK: judged_sellers(report, "sellers", chunk_rows),
    "hb_sellers": lambda report, chunk_rows=ROWS_PER_CHUNK: judged_sellers(report, "hb_sellers", chunk_rows),
    "channel": judged_channel,
    "commissions": judged_commissions,
    "branch_totals": judged_totals,
    "pos_staff": judged_pos_staff,
}


def judged_rows(kind: str, report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """``file``, ``row_idx`` and ``reason`` (null: kept) of every row below the header, written once."""
    return staged(JUDGES[kind](report, chunk_rows=chunk_rows), f"judged-{kind}")


def drop_report(judged: DataFrame, step: str) -> DataFrame:
    """``step``, ``file``, ``outcome`` (kept, or the reason), ``rows`` and the first of them."""
    outcome = F.coalesce(REASON, F.lit(KEPT)).alias("outcome")
    counted = judged.groupBy(FILE, outcome).agg(F.count(F.lit(1)).alias("rows"), F.min(ROW).alias("first_row"))
    return counted.select(F.lit(step).alias("step"), FILE, "outcome", "rows", "first_row")


def judged_second_targets(roster: DataFrame, second: DataFrame) -> DataFrame:
    """Every second-target row with the ``reason`` it adds nobody for (null: it does)."""
    ids = roster.select("id").distinct().withColumn("on_roster", F.lit(True))
    codes = roster.select(F.col("code").cast("string").alias("code_key")).distinct().withColumn("known", F.lit(True))
    reason = F.when(F.col("on_roster"), "already on the roster").when(
        F.col("known").isNull(), "nobody on the roster has the code"
    )
    return second.join(ids, "id", "left").join(codes, "code_key", "left").select(*second.columns, reason.alias(REASON))


def judged_people(hr: DataFrame, pos: DataFrame, pad: bool | str = False) -> DataFrame:
    """``side``, ``cpf`` and ``reason`` of every HR and point-of-sale row (null: it has a match)."""
    hr_rows = people.hr_rows(hr, pad).select(F.lit("hr").alias("side"), "cpf", F.col("branch").isNull().alias("keyless"))
    pos_rows = people.pos_rows(pos, pad).select(F.lit("pos").alias("side"), "cpf", F.col("code").isNull().alias("keyless"))
    rows = staged(hr_rows.unionByName(pos_rows), "sides")
    filled = rows.where("cpf <> ''")
    sides = filled.groupBy("cpf").agg(
        F.bool_or(F.col("side") == "hr").alias("hr"),
        F.bool_or(F.col("side") == "pos").alias("pos"),
        F.bool_or((F.col("side") == "hr") & ~F.col("keyless")).alias("hr_key"),
        F.bool_or((F.col("side") == "pos") & ~F.col("keyless")).alias("pos_key"),
    )
    other_key = F.when(F.col("side") == "hr", F.col("pos_key")).otherwise(F.col("hr_key"))
    reason = (
        F.when(F.coalesce(F.col("cpf") == "", F.lit(True)), "no tax id")
        .when(~(F.col("hr") & F.col("pos")), "tax id is not on the other side")
        .when(F.col("keyless") | ~other_key, "no branch or code")
    )
    return rows.join(sides, "cpf", "left").select("side", "cpf", reason.alias(REASON))


def outcome_counts(judged: DataFrame, step: str, *by: str) -> DataFrame:
    """``step``, ``by``, ``outcome`` and ``rows`` of judged rows that have no place in a file."""
    outcome = F.coalesce(REASON, F.lit(KEPT)).alias("outcome")
    return judged.groupBy(*by, outcome).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(step).alias("step"), *by, "outcome", "rows"
    )
