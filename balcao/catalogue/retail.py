"""A star schema of orders seen as a shop chain.

Nations are branches, suppliers are sellers and staff, customers are the people of the
HR lists, and order lines are sales. The tables come out in the same shapes the
calculation reads: flat text tables and printed-report grids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import text as t
from balcao.functions.money import cents, round2, sum_money
from balcao.operators.ordered import FILE, ROW
from balcao.plans.monthly import MonthTables
from balcao.sources.staging import staged

CHANNEL_CODE = 5
HB_TYPE = "ECONOMY"
EXCLUDED_SIZES = (20, 39, 15)
COMMISSION_RATE = 0.013
BRANCHES = 25
TITLES = (*vocab.COMMISSIONED_ROLES, "REPOSITOR", "AUXILIAR - ESTOQUE")
TARGET_RATIOS = (0.735, 0.825, 0.915, 1.005, 1.06, 1.185)
COST_OFFSETS = (2.5, 1.5, 0.5, -1.0)
# Row numbers a report section may take; sections of a file never overlap.
SECTION_ROWS = 10_000_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(values: tuple, index: Column) -> Column:
    """``values[index]`` for a non-negative index."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: branch, seller code, order, part, amount, tax, day sold."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("c_nationkey").cast("bigint").alias("branch"),
        F.col("l_suppkey").alias("code"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_tax").alias("tax"),
        F.col("o_orderdate").alias("sold_at"),
    )


def seller_totals(spark: SparkSession, folder: str) -> DataFrame:
    """``branch``, ``code``, ``amount``: what each seller sold in each branch."""
    lines = sale_lines(spark, folder)
    return lines.groupBy("branch", "code").agg(sum_money(F.col("amount")).alias("amount"))


def hb_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of the health-and-beauty group outside the excluded departments."""
    parts = table(spark, folder, "part")
    kept = (F.col("p_type") == HB_TYPE) & ~F.col("p_size").isin(*EXCLUDED_SIZES)
    return parts.where(kept).select("p_partkey")


def branch_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Per branch: revenue, HB revenue, cost and average ticket.

    Lines are summed per order before they meet the orders, so the orders of a branch are
    counted as rows, and no branch's order keys are gathered. Sums stay whole numbers:
    cents, and hundredths of a cent for cost.
    """
    parts = hb_parts(spark, folder)
    lines = table(spark, folder, "lineitem").join(
        parts, F.col("l_partkey") == F.col("p_partkey"), "left"
    )
    price = cents(F.col("l_extendedprice"))
    per_order = lines.groupBy("l_orderkey").agg(
        F.sum(price).alias("revenue"),
        F.sum(F.when(F.col("p_partkey").isNotNull(), price)).alias("hb"),
        F.sum(price * (60 + cents(F.col("l_tax")))).alias("cost"),
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    sums = placed.groupBy(F.col("c_nationkey").cast("bigint").alias("branch")).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("hb").alias("hb"),
        F.sum(F.col("cost").cast("decimal(20,0)")).cast("double").alias("cost"),
        F.count("*").alias("orders"),
    )
    revenue = F.col("revenue") / 100
    return sums.select(
        "branch",
        revenue.alias("revenue"),
        F.coalesce(F.col("hb") / 100, F.lit(0.0)).alias("hb"),
        round2(F.col("cost") / 10000).alias("cost"),
        round2(revenue / F.col("orders")).alias("ticket"),
    )


# ---- staff ---------------------------------------------------------------------------


def staff(spark: SparkSession, folder: str) -> DataFrame:
    """``branch``, ``code``, ``name``, ``title`` of every seller."""
    sellers = table(spark, folder, "supplier")
    number = F.pmod(F.col("s_suppkey"), F.lit(len(TITLES)))
    title = F.concat(
        F.lpad((number + 10).cast("string"), 2, "0"),
        F.lit(" - "),
        pick(TITLES, F.col("s_suppkey")),
    )
    return sellers.select(
        F.col("s_nationkey").cast("bigint").alias("branch"),
        F.col("s_suppkey").alias("code"),
        F.col("s_name").alias("name"),
        title.alias("title"),
    )


def code_text(code: Column) -> Column:
    """Codes the way a sheet may show them: even ones with a trailing ``.0``."""
    return F.when(code % 2 == 0, F.concat(code.cast("string"), F.lit(".0"))).otherwise(
        code.cast("string")
    )


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def people_tab(people: DataFrame) -> DataFrame:
    return people.select(
        F.concat(F.lit("F"), two_digits(F.col("branch"))).alias("Filial"),
        code_text(F.col("code")).alias("Código"),
        F.lpad(F.col("code").cast("string"), 11, "0").alias("CPF"),
        F.col("name").alias("Nome"),
        F.col("title").alias("Cargo atual"),
    )


def _person_list(people: DataFrame, branch: Column) -> DataFrame:
    return people.select(
        t.person_id(branch, F.col("code")).alias("ID"),
        branch.cast("string").alias("Filial"),
        code_text(F.col("code")).alias("Código"),
        F.col("name").alias("Colaborador"),
    )


def trainees_tab(people: DataFrame) -> DataFrame:
    return _person_list(people.where(F.col("code") % 10 == 3), F.col("branch"))


def other_branch() -> Column:
    return F.pmod(F.col("branch") + 1, F.lit(BRANCHES))


def second_targets_tab(people: DataFrame) -> DataFrame:
    """Every tenth seller also has a target in the next branch, some listed for their own."""
    chosen = people.where(F.col("code") % 10 == 4)
    own = chosen.where(F.col("code") % 20 == 4)
    return _person_list(chosen, other_branch()).unionByName(_person_list(own, F.col("branch")))


def leave_tab(people: DataFrame) -> DataFrame:
    """People on leave; every other one is listed with a padded branch that must not match."""
    chosen = people.where(F.col("code") % 17 == 6)
    branch = F.when(F.col("code") % 2 == 0, F.col("branch").cast("string")).otherwise(
        F.concat(F.lit("0"), F.col("branch").cast("string"))
    )
    return chosen.select(
        branch.alias("Filial"), F.concat(F.lit(" "), F.lower("name")).alias("Colaborador")
    )


def previous_tab(people: DataFrame, sold: DataFrame) -> DataFrame:
    """Last month's output: targets around what was sold, some blank, zero or outdated."""
    per_code = sold.groupBy("code").agg(sum_money(F.col("amount")).alias("sold"))
    known = people.join(per_code, "code")
    target = round2(F.col("sold") / pick(TARGET_RATIOS, F.col("code")))
    shown = (
        F.when(F.col("code") % 11 == 0, "")
        .when(F.col("code") % 13 == 0, "0,00")
        .otherwise(t.br_text(target))
    )
    listed = F.col("code") % 10 == 4
    rows = F.array(
        F.struct(F.col("branch").alias("at"), F.lit(2).alias("step"), shown.alias("Meta")),
        F.struct(
            F.when(listed, other_branch()).alias("at"), F.lit(3).alias("step"), shown.alias("Meta")
        ),
        F.struct(
            F.when((F.col("code") % 11 != 0) & (F.col("code") % 3 == 0), F.col("branch")).alias("at"),
            F.lit(0).alias("step"),
            F.lit("1,00").alias("Meta"),
        ),
    )
    return (
        known.select("code", F.inline(rows))
        .where(F.col("at").isNotNull())
        .select(
            t.person_id(F.col("at"), F.col("code")).alias("ID"),
            "Meta",
            (F.col("code") * 4 + F.col("step")).alias("row_idx"),
        )
    )


# ---- flat tables ---------------------------------------------------------------------


def seller_sales_tab(sold: DataFrame) -> DataFrame:
    return sold.select(
        F.concat(F.lit("F"), F.col("branch").cast("string")).alias("Filial"),
        code_text(F.col("code")).alias("Código"),
        F.concat(F.lit("V"), F.col("code").cast("string")).alias("Vendedor"),
        t.br_text(F.col("amount")).alias("Valor Vendas"),
    )


def commission_of(amount: Column) -> Column:
    return round2(amount * COMMISSION_RATE)


def commissions_tab(sold: DataFrame) -> DataFrame:
    """Branches are written ``01`` or ``1``; branch 7 is written both ways."""
    plain = (F.col("branch") % 3 == 0) | ((F.col("branch") == 7) & (F.col("code") % 2 == 0))
    return sold.select(
        F.when(plain, F.col("branch").cast("string"))
        .otherwise(two_digits(F.col("branch")))
        .alias("Filial"),
        code_text(F.col("code")).alias("Código"),
        t.br_text(commission_of(F.col("amount"))).alias("Valor Comissão"),
    )


def channel_tab(sold: DataFrame) -> DataFrame:
    channel = sold.where(F.col("code") == CHANNEL_CODE)
    return channel.select(
        F.col("branch").cast("string").alias("Filial"),
        t.br_text(F.col("amount")).alias("Valor Vendas"),
        t.br_text(t.channel_share(F.col("amount"))).alias("40% VT"),
    )


def branch_sales_tab(branches: DataFrame) -> DataFrame:
    return branches.select(
        F.concat(F.lit("F"), two_digits(F.col("branch"))).alias("Filial"),
        t.br_text(F.col("hb")).alias("Faturamento HB"),
        t.br_text(F.col("cost")).alias("Custo Total"),
        t.br_text(F.col("revenue")).alias("Faturamento Total"),
        t.br_text(F.col("ticket")).alias("Ticket Médio"),
        F.col("branch").cast("bigint").alias("row_idx"),
    )


def _stretched(value: str, base: float, step: float, index: Column) -> Column:
    return round2(F.col(value) / (F.lit(base) + F.lit(step) * index.cast("double")))


def branch_targets_tab(branches: DataFrame) -> DataFrame:
    """Targets that put branches on every scorecard step; one branch has a zero target."""
    branch = F.col("branch")
    revenue = _stretched("revenue", 0.98, 0.0155, F.pmod(branch, F.lit(5)))
    hb = _stretched("hb", 0.98, 0.0155, F.pmod(branch + 1, F.lit(5)))
    ticket = _stretched("ticket", 0.97, 0.045, F.pmod(branch, F.lit(4)))
    cost = round2(F.col("cost") / F.col("revenue") * 100) + pick(COST_OFFSETS, branch)
    return branches.select(
        branch.cast("bigint").alias("row_idx"),
        branch.cast("string").alias("Filial"),
        t.br_text(F.when(branch == 11, 0.0).otherwise(revenue)).alias("Number"),
        t.br_text(hb).alias("HB"),
        t.br_text(ticket).alias("TKT MÉDIO"),
        t.percent_text(cost).alias("CMV"),
    )


def seller_mart(spark: SparkSession, folder: str) -> DataFrame:
    """``seller_totals`` written once, for queries that use it several times."""
    return staged(seller_totals(spark, folder), "seller-totals")


def branch_mart(spark: SparkSession, folder: str) -> DataFrame:
    return staged(branch_totals(spark, folder), "branch-totals")


def month_tables(
    spark: SparkSession, folder: str, sold: DataFrame, with_branches: bool = True
) -> MonthTables:
    """All tables of a month from two passes over the sales: per seller and per branch."""
    people = staff(spark, folder)
    branches = branch_mart(spark, folder) if with_branches else None
    return MonthTables(
        people=people_tab(people),
        seller_sales=seller_sales_tab(sold),
        commissions=commissions_tab(sold),
        branch_sales=branch_sales_tab(branches) if with_branches else None,
        branch_targets=branch_targets_tab(branches) if with_branches else None,
        channel_sales=channel_tab(sold),
        trainees=trainees_tab(people),
        second_targets=second_targets_tab(people),
        leave=leave_tab(people),
        previous=previous_tab(people, sold),
    )


# ---- printed reports -----------------------------------------------------------------


def monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    """``month``, ``branch``, ``code``, ``amount``."""
    lines = sale_lines(spark, folder)
    sums = lines.groupBy(F.trunc("sold_at", "month").alias("day"), "branch", "code").agg(
        sum_money(F.col("amount")).alias("amount")
    )
    return sums.select(F.date_format("day", "yyyy-MM").alias("month"), "branch", "code", "amount")


def cells(*values: str | Column) -> Column:
    return F.array(*[F.lit(v) if isinstance(v, str) else v for v in values])


def section_row(start: int, offset: Column | int) -> Column:
    shift = F.lit(offset) if isinstance(offset, int) else offset
    return F.lit(start).cast("bigint") + F.col("branch") * SECTION_ROWS + shift


def print_report(
    sold: DataFrame,
    keys: list[str],
    head: list[tuple[int, Column]],
    section: Callable[[], list[tuple[Column, Column]]],
    detail: Callable[[], list[tuple[Column, Column]]],
) -> DataFrame:
    """Lay sums out as a printed report: title rows per file, sections per branch, details.

    ``keys`` are the file columns. ``sold`` has one row for each file, branch and code and is
    read twice: its rows are the details as they are, and sections and titles come from one
    rollup that never holds more than these.
    """
    money = F.col("amount")
    levels = sold.rollup(*keys, "branch").agg(sum_money(money).alias("amount"), F.grouping_id().alias("level"))

    def rows(pairs: list[tuple]) -> Column:
        return F.array(
            *[
                F.struct(
                    (F.lit(at) if isinstance(at, int) else at).cast("bigint").alias(ROW),
                    c.alias("cells"),
                )
                for at, c in pairs
            ]
        )

    file = F.concat_ws("-", *keys).alias(FILE)
    printed = F.when(F.col("level") == 1, rows(head)).when(F.col("level") == 0, rows(section()))
    # The sum of one amount, as the sections' sums are put together.
    single = cents(money) / 100 + (money - cents(money) / 100)
    details = sold.withColumn("amount", single).select(file, F.inline(rows(detail())))
    lines = details.unionByName(levels.select(file, F.inline(printed)))
    return lines.where(F.col(ROW).isNotNull())


def _branch_label() -> Column:
    """Some sections are printed without their branch."""
    return F.when(F.col("branch") % 9 != 8, F.col("branch").cast("string")).otherwise("")


def seller_grid(sold: DataFrame, keys: tuple[str, ...] = ("month",)) -> DataFrame:
    code = F.col("code").cast("string")
    return print_report(
        sold,
        list(keys),
        [
            (0, cells("Vendas por Vendedor")),
            (9, cells(" Código ", "a", "b", "", "Vendedor", "Qtd. Vendas", "Valor Custo", "Valor Vendas")),
        ],
        lambda: [
            (section_row(10, 0), cells("FILIAL: ", "", "", _branch_label())),
            (
                section_row(10, SECTION_ROWS - 1),
                cells("Total", "", "", "", "", "", "", t.br_text(F.col("amount"))),
            ),
        ],
        lambda: [
            (
                section_row(10, F.col("code") + 1),
                cells(
                    F.concat(F.lit(" "), code),
                    "",
                    "",
                    "",
                    F.concat(F.lit("V"), code),
                    "1",
                    "",
                    t.br_text(F.col("amount")),
                ),
            )
        ],
    )


def commission_grid(sold: DataFrame) -> DataFrame:
    code = F.col("code").cast("string")
    base = t.br_text(F.col("amount"))
    return print_report(
        sold,
        ["month"],
        [
            (0, cells("Comissões")),
            (10, cells("Código", "Vendedor", "Base Comissão", "% Comissão", "Valor Comissão")),
            (11, cells("77", "sem filial", "1,00", "1,3", "0,01")),
        ],
        lambda: [
            (section_row(20, 0), cells("Filial:", _branch_label())),
            (section_row(20, SECTION_ROWS - 1), cells("Total", "", base, "", "")),
        ],
        lambda: [
            (
                section_row(20, F.col("code") + 1),
                cells(
                    code,
                    F.concat(F.lit("V"), code),
                    base,
                    "1,3",
                    t.br_text(commission_of(F.col("amount"))),
                ),
            )
        ],
    )


def branch_total_grid(sold: DataFrame) -> DataFrame:
    """Sections without a branch row, without an HB row, or with the HB row first."""
    branch = F.col("branch")
    amount = t.br_text(F.col("amount"))
    kind = F.pmod(branch, F.lit(7))
    blank = F.lit("")
    return print_report(
        sold,
        ["month"],
        [
            (
                0,
                cells(
                    "Código",
                    "Descrição",
                    "Total Vlr. Venda",
                    "Total Vlr. Custo",
                    "Vlr. Descto",
                    "Ticket Médio Venda/Devol.",
                ),
            )
        ],
        lambda: [
            (
                section_row(1, F.when(kind == 3, F.lit(None)).otherwise(1)),
                cells("Filial:", F.concat(branch.cast("string"), F.lit(" LOJA")), blank, blank, blank, blank),
            ),
            (
                section_row(1, F.when(kind == 4, F.lit(None)).when(kind == 1, 0).otherwise(2)),
                cells("8000", "HB", amount, blank, blank, blank),
            ),
            (
                section_row(1, SECTION_ROWS - 1),
                cells("Total Filial", blank, blank, t.br_text(F.col("amount") * 0.5), amount, "9,99"),
            ),
        ],
        lambda: [
            (
                section_row(1, F.col("code") + 3),
                cells((F.col("code") + 10000).cast("string"), "GRUPO", amount, blank, blank, blank),
            )
        ],
    )


def channel_grid(sold: DataFrame) -> DataFrame:
    """One report per seller and month; a branch's sales stand below its name."""
    per_file = sold.select("month", "code", "branch", "amount")
    plain = F.col("amount").cast("decimal(18,2)").cast("string")
    shown = F.when(F.col("branch") % 5 == 0, t.br_text(F.col("amount"))).otherwise(plain)
    head = cells(
        "", "", "Código", "", " Vendedor", "Qtd. Vendas", "", "Valor Custo", "Margem Lucro", "Valor Vendas"
    )
    blank = ("", "", "")

    def row(at: Column, c: Column) -> Column:
        return F.struct(at.cast("bigint").alias(ROW), c.alias("cells"))

    body = per_file.select(
        F.concat_ws("-", "month", F.col("code").cast("string")).alias(FILE),
        F.inline(
            F.array(
                row(
                    F.lit(10) + F.col("branch") * 2,
                    cells(*blank, F.col("branch").cast("string"), *blank, "", "", ""),
                ),
                row(F.lit(11) + F.col("branch") * 2, cells(*blank, "", *blank, "", "", shown)),
            )
        ),
    )
    heads = per_file.select(
        F.concat_ws("-", "month", F.col("code").cast("string")).alias(FILE)
    ).distinct()
    return heads.select(FILE, F.lit(9).cast("bigint").alias(ROW), head.alias("cells")).unionByName(body)


def punctuated(cpf: Column) -> Column:
    return F.regexp_replace(cpf, r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4")


def cpf_of(key: Column) -> Column:
    return F.lpad(key.cast("string"), 11, "0")


def pos_staff_grid(spark: SparkSession, folder: str) -> DataFrame:
    """One staff list per nation; each person takes two rows, with the tax id on the second."""
    key = F.col("c_custkey")
    code = F.when(key % 50 == 7, "123456789").when(key % 50 == 9, "Página 1 de").otherwise(
        code_text(key)
    )
    head = F.array(
        *[
            F.lit(v)
            for v in (
                "",
                " Código\u00a0",
                "Nome do  Funcionário",
                "",
                "",
                "Admissão",
                "Operad.Cx.",
                "Vendedor",
                "Status",
                "Demissão",
            )
        ]
    )
    people = table(spark, folder, "customer")
    file = F.concat(F.lit("staff-"), F.col("c_nationkey").cast("string")).alias(FILE)
    person = cells("", code, F.col("c_name"), "", "", "01/02/2020", "N", "S", "Ativo", "05/06/2024")
    below = cells("", "", "", "", "", "", "", "", "", punctuated(cpf_of(key)))
    body = people.select(
        file,
        F.inline(
            F.array(
                F.struct((key * 2 + 10).alias(ROW), person.alias("cells")),
                F.struct((key * 2 + 11).alias(ROW), below.alias("cells")),
            )
        ),
    )
    heads = people.select(file).distinct()
    return heads.select(FILE, F.lit(8).cast("bigint").alias(ROW), head.alias("cells")).unionByName(body)


# ---- HR and point-of-sale lists ------------------------------------------------------


def hr_list(spark: SparkSession, folder: str) -> DataFrame:
    """HR side: punctuated tax ids, every hundredth missing."""
    people = table(spark, folder, "customer")
    key = F.col("c_custkey")
    return people.select(
        F.col("c_nationkey").cast("string").alias("Filial (loja)"),
        F.when(key % 100 == 99, "").otherwise(punctuated(cpf_of(key))).alias("Nº CPF"),
        F.concat(F.lit("01 - "), F.col("c_mktsegment")).alias("Cargo atual"),
        F.col("c_name").alias("Nome"),
    )


def pos_list(spark: SparkSession, folder: str) -> DataFrame:
    """Point-of-sale side: bare tax ids, some blank, every tenth person listed twice."""
    people = table(spark, folder, "customer")
    key = F.col("c_custkey")
    copies = F.when(key % 10 == 1, 2).otherwise(1)
    return people.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select(
        F.concat(key.cast("string"), F.lit("0"), F.col("copy").cast("string")).alias("Código usuário"),
        F.concat(F.col("c_name"), F.lit(" *")).alias("Nome do Funcionário"),
        F.when(key % 25 == 4, " ").otherwise(cpf_of(key)).alias("CPF"),
    )
