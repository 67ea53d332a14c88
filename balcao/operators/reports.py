"""Printed-report grids flattened into the tables the calculation reads.

Input is always ``report_cells``: ``file``, ``row_idx``, ``cells``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as t
from balcao.functions.money import sum_money
from balcao.operators.ordered import (
    FILE,
    ROW,
    ROWS_PER_CHUNK,
    fill_down,
    running_last,
    shift_up,
)
from balcao.operators.quarantine import Check, Split, split
from balcao.sources.grids import (
    cell_at,
    column_position,
    first_position_outside,
    last_position_containing,
    with_header,
)
from balcao.sources.staging import staged


def _holds(text: Column, part: str) -> Column:
    return F.coalesce(F.contains(text, F.lit(part)), F.lit(False))


def _columns_below(
    report: DataFrame, header_row: int, places: dict[str, Column], required: tuple[str, ...] = ()
) -> DataFrame:
    """``file``, ``row_idx`` and the cells at ``places`` of the rows below the header."""
    at = {f"at{i}": place for i, place in enumerate(places.values())}
    found = with_header(report, header_row, required, **at)
    return found.select(FILE, ROW, *[cell_at(F.col(p)).alias(name) for p, name in zip(at, places)])


def _named(**columns: str) -> dict[str, Column]:
    return {name: column_position(title) for name, title in columns.items()}


def seller_lines(report: DataFrame, header_row: int) -> DataFrame:
    """All rows of a seller report below its header, in columns."""
    places = _named(
        code="código",
        section_branch="unnamed: 3",
        seller="vendedor",
        quantity="qtd. vendas",
        cost="valor custo",
        amount="valor vendas",
    )
    return _columns_below(report, header_row, places).withColumn("code", t.strip(F.col("code")))


def names_seller_branch() -> Column:
    return _holds(F.lower("code"), "filial:")


def fill_seller_branches(lines: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Section and detail rows, each with the branch of its section."""
    relevant = lines.where(names_seller_branch() | t.is_digits(F.col("code")))
    return fill_down(relevant, names_seller_branch(), F.col("section_branch"), "branch", chunk_rows)


def seller_rows(
    report: DataFrame, header_row: int, chunk_rows: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Detail rows of a seller report, each with the branch of the section it stands in.

    A section starts at a row with ``filial:`` in the code cell; its branch stands in the
    fourth, unnamed column. Rows above the first section keep a null branch.
    """
    filled = fill_seller_branches(seller_lines(report, header_row), chunk_rows)
    return filled.where(~names_seller_branch()).drop("section_branch")


def seller_report(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """VENDAS_VENDEDOR."""
    rows = seller_rows(report, vocab.HEADER_ROW["sellers"], chunk_rows)
    return rows.select(
        F.col("branch").alias("Filial"),
        F.col("code").alias("Código"),
        F.col("seller").alias("Vendedor"),
        F.col("amount").alias("Valor Vendas"),
    )


def hb_seller_totals(rows: DataFrame) -> DataFrame:
    """Sales per seller code, with the first known name; some codes never count.

    Needs ``code``, ``seller``, ``amount`` and the row position ``file``, ``row_idx``.
    """
    counted = rows.where(~F.col("code").isin(*vocab.HB_IGNORED_CODES))
    named = F.when(F.col("seller").isNotNull(), F.struct(FILE, ROW, "seller"))
    return counted.groupBy("code").agg(
        F.min(named).getField("seller").alias("seller"),
        sum_money(F.col("amount")).alias("amount"),
        F.count("*").alias("rows"),
    )


def hb_seller_report(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """VENDAS_VENDEDOR_HB, amounts as text."""
    rows = seller_rows(report, vocab.HEADER_ROW["hb_sellers"], chunk_rows)
    typed = rows.withColumns(
        {"code": F.col("code").try_cast("bigint"), "amount": t.br_or_zero(F.col("amount"))}
    )
    return hb_seller_totals(typed).select(
        F.col("code").alias("Código"),
        F.col("seller").alias("Vendedor"),
        t.br_text_keep_zero_sign(F.col("amount")).alias("Valor Vendas"),
    )


def duplicate_count(rows: DataFrame, key: str) -> DataFrame:
    """How many rows repeat a key that was seen before."""
    per_key = rows.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg((F.sum("n") - F.count("*")).alias("duplicates"))


def channel_lines(report: DataFrame) -> DataFrame:
    """All rows of a channel report below its header: ``branch`` and ``sales`` as printed."""
    places = {"branch": first_position_outside(vocab.CHANNEL_DROPPED_COLUMNS), **_named(sales="valor vendas")}
    return _columns_below(report, vocab.HEADER_ROW["channel"], places, ("valor vendas",))


def channel_report(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """VENDAS_548: a branch's sales stand one row below its name."""
    # Gone over twice, and narrow: written once, the rows meet their headers once.
    lines = staged(channel_lines(report), "lines")
    shifted = shift_up(lines, ["sales"], chunk_rows).where(F.col("branch").isNotNull())
    sales = t.to_number(F.col("sales"))
    return shifted.select(
        F.col("branch").alias("Filial"),
        sales.alias("Valor Vendas"),
        t.channel_share(sales).alias("40% VT"),
    )


def commission_lines(report: DataFrame) -> DataFrame:
    """All rows of a commission report below its header."""
    required = ("código", "vendedor", "base comissão", "% comissão", "valor comissão")
    places = {name: column_position(name) for name in required}
    return _columns_below(report, vocab.HEADER_ROW["commissions"], places, required)


def names_commission_branch() -> Column:
    return _holds(F.col("código"), "Filial:")


def fill_commission_branches(lines: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Section and detail rows, each with the branch of its section (null where it is blank)."""
    relevant = lines.where(names_commission_branch() | t.is_digits(F.col("código")))
    return fill_down(relevant, names_commission_branch(), t.strip(F.col("vendedor")), "branch", chunk_rows)


def commission_rows(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """COMISSOES with branches as printed: rows under no branch, or a blank one, do not count."""
    filled = fill_commission_branches(commission_lines(report), chunk_rows)
    detail = filled.where(~names_commission_branch() & F.col("branch").isNotNull())
    return detail.select(
        F.col("branch").alias("Filial"),
        F.col("código").alias("Código"),
        F.col("vendedor").alias("Colaborador"),
        F.col("base comissão").alias("Base Comissão"),
        F.col("% comissão").alias("% Comissão"),
        F.col("valor comissão").alias("Valor Comissão"),
    )


def _with_branch_numbers(rows: DataFrame) -> DataFrame:
    number = t.to_whole(F.col("Filial"), "a branch number").cast("string")
    return rows.withColumn("Filial", t.zero_pad2(number))


def commission_report(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """COMISSOES. A branch that is not a number fails the job."""
    return _with_branch_numbers(commission_rows(report, chunk_rows))


def split_commission_report(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> Split:
    """COMISSOES, and the rows whose branch is not a number."""
    check = Check("Filial", "not a branch number", t.is_whole)
    found = split(commission_rows(report, chunk_rows), "COMISSOES", [check])
    return Split(_with_branch_numbers(found.good), found.bad)


def total_lines(report: DataFrame) -> DataFrame:
    """All rows of a branch report below its header, in columns."""
    required = ("código", "total vlr. venda", "total vlr. custo", "vlr. descto", "ticket médio venda/devol.")
    code = column_position("código")
    places = dict(
        zip(("code", "sales", "cost", "revenue", "ticket"), map(column_position, required)), after_code=code + 1
    )
    lines = _columns_below(report, vocab.HEADER_ROW["branch_totals"], places, required)
    branch = t.first_word(F.coalesce("after_code", F.lit("None")))
    return lines.select(
        FILE, ROW, t.strip(F.col("code")).alias("code"), branch.alias("branch"), "sales", "cost", "revenue", "ticket"
    )


def total_row_kinds() -> tuple[Column, Column, Column]:
    """Which rows name a branch, hold the HB sales, or are totals."""
    return (
        F.coalesce(F.lower("code") == "filial:", F.lit(False)),
        F.coalesce(F.col("code") == vocab.HB_PRODUCT_GROUP, F.lit(False)),
        F.coalesce(F.lower("code").startswith("total filial"), F.lit(False)),
    )


def judge_totals(lines: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Branch, HB and total rows; of totals, whether each ``counts`` and the branch above it."""
    is_branch, is_hb, is_total = total_row_kinds()
    # Few rows matter, and they are gone over four times: written once, they are cheap.
    relevant = staged(lines.where(is_branch | is_hb | is_total), "branch-total-rows")
    located = running_last(
        relevant,
        {
            "last_branch": (is_branch, F.col("branch")),
            "last_total": (is_total, F.lit(None).cast("string")),
        },
        True,
        chunk_rows,
    )
    above = F.coalesce(F.col("last_total.at"), F.lit(-1))
    counts = is_total & F.coalesce(F.col("last_branch.at") > above, F.lit(False))
    return located.withColumn("counts", counts)


def branch_totals(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """VENDAS_FILIAL: one record per branch section that ends in a total row.

    A total counts if a branch row stands between it and the total above. Its HB sales are
    the last group-8000 row since the last total that counted, so they may come from above
    the branch row. Revenue is printed in the discount column of the total row.
    """
    is_hb = total_row_kinds()[1]
    placed = running_last(
        judge_totals(total_lines(report), chunk_rows),
        {
            "last_hb": (is_hb, F.col("sales")),
            "last_counted": (F.col("counts"), F.lit(None).cast("string")),
        },
        True,
        chunk_rows,
    )
    hb_is_fresh = F.col("last_hb.at") > F.coalesce(F.col("last_counted.at"), F.lit(-1))
    return placed.where("counts").select(
        FILE,
        ROW,
        t.zero_pad2(F.col("last_branch.value")).alias("Filial"),
        F.when(hb_is_fresh, F.col("last_hb.value")).alias("Faturamento HB"),
        F.col("cost").alias("Custo Total"),
        F.col("revenue").alias("Faturamento Total"),
        F.col("ticket").alias("Ticket Médio"),
    )


def pos_staff_lines(report: DataFrame) -> DataFrame:
    """All rows of a staff list below its header, in columns."""
    places = {
        "code": last_position_containing("código", "codigo"),
        "name": last_position_containing("funcionário", "funcionario"),
        **_named(below="demissão"),
        "beside": last_position_containing("cpf"),
    }
    return _columns_below(report, vocab.HEADER_ROW["pos_staff"], places)


def pos_staff(report: DataFrame, chunk_rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Point-of-sale staff: the tax id is printed one row below its person."""
    shifted = shift_up(pos_staff_lines(report), ["below"], chunk_rows)
    kept = shifted.where(
        t.to_number(F.col("code")).isNotNull() & ~F.col("code").isin(*vocab.POS_DUMMY_CODES)
    )
    return kept.select(
        F.col("code").alias("Código"),
        F.col("name").alias("Funcionário"),
        F.coalesce("beside", "below").alias("CPF"),
    )
