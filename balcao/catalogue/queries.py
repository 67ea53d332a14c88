"""Every operator as a query over a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from balcao import vocab
from balcao.functions import period
from balcao.functions import text as t
from balcao.functions.money import round2, sum_money
from balcao.operators import payout, people, reports, roster, sales, scorecard, source_filters
from balcao.operators.ordered import FILE
from balcao.catalogue import files, retail
from balcao.plans import export, monthly
from balcao.catalogue.retail import table
from balcao.sources import columns, grids, hr_files, latest, lines, snapshots, tabs
from balcao.sources.staging import new_folder, staged

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "1998-06-20"
FIRST_OF_MONTH = "1997-05-01"


# ---- text ----------------------------------------------------------------------------


def br_number_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Line prices written eight ways, read back."""
    price = F.col("l_extendedprice")
    variant = F.pmod("l_orderkey", F.lit(8))
    written = t.br_text(price)
    text = (
        F.when(variant == 0, written)
        .when(variant == 1, F.concat(F.lit(" "), written, F.lit("\u00a0")))
        .when(variant == 2, price.cast("decimal(18,2)").cast("string"))
        .when(variant == 3, F.concat(F.lit("("), written, F.lit(")")))
        .when(variant == 4, F.concat(F.lit("R$ "), written))
        .when(variant == 5, "")
        .when(variant == 6, F.concat(F.lit("-"), written))
        .otherwise(F.when(F.col("l_linenumber") % 2 == 1, "nan").otherwise("inf"))
    )
    texts = (
        table(spark, folder, "lineitem")
        .select(variant.alias("variant"), text.alias("text"))
        .groupBy("variant", "text")
        .agg(F.count("*").alias("n"))
    )
    return texts.select("variant", "text", "n", t.br_to_double(F.col("text")).alias("value"))


def br_number_format(spark: SparkSession, folder: str) -> DataFrame:
    """Signed amounts of every line in all text forms."""
    value = F.when(F.col("l_orderkey") % 97 == 0, F.lit(-0.001)).otherwise(
        (F.col("l_discount") - 0.05) * F.col("l_extendedprice") * 0.5
    )
    values = table(spark, folder, "lineitem").select(value.alias("value"))
    distinct = values.groupBy("value").agg(F.count("*").alias("n"))
    v = F.col("value")
    return distinct.select(
        "value",
        "n",
        round2(v).alias("rounded"),
        t.br_text(v).alias("signed"),
        t.br_text_unsigned(v).alias("unsigned"),
        t.br_text_in_parentheses(v).alias("parentheses"),
        t.br_text_keep_zero_sign(v).alias("zero_signed"),
    )


def quantity_format(spark: SparkSession, folder: str) -> DataFrame:
    """Whole and fractional quantities, and text that is no number."""
    kind = F.pmod("l_orderkey", F.lit(3))
    text = (
        F.when(kind == 0, (F.col("l_quantity") * 1000).cast("decimal(18,1)").cast("string"))
        .when(kind == 1, F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
        .otherwise(F.concat(F.lit("x"), F.col("l_linenumber").cast("string")))
    )
    texts = table(spark, folder, "lineitem").select(text.alias("text"))
    counted = texts.groupBy("text").agg(F.count("*").alias("n"))
    return counted.select("text", "n", t.quantity_text(F.col("text")).alias("shown"))


def percent_text(spark: SparkSession, folder: str) -> DataFrame:
    """Percentages of every order as text, the positive ones read back."""
    points = round2(F.col("o_totalprice") / 1000 - 150)
    counted = (
        table(spark, folder, "orders")
        .select(points.alias("points"))
        .groupBy("points")
        .agg(F.count("*").alias("n"))
    )
    shown = t.percent_text(F.col("points"))
    return counted.select(
        "points",
        "n",
        shown.alias("text"),
        t.percent_to_double(F.when(F.col("points") >= 0, shown)).alias("value"),
    )


def branch_code_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Branch and code texts of every customer, normalised by each key rule."""
    key, branch = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    padded = F.lpad(branch, 2, "0")
    form = key % 6
    text = (
        F.when(form == 0, F.concat(F.lit("F"), padded))
        .when(form == 1, F.concat(F.lit(" f"), padded, F.lit("\t")))
        .when(form == 2, F.concat(branch, F.lit(".0")))
        .when(form == 3, padded)
        .when(form == 4, F.lit("MATRIZ"))
        .otherwise(F.concat(F.lit("FF"), branch))
    )
    code = F.concat(
        key.cast("string"),
        F.when(key % 3 == 0, ".0").when(key % 3 == 1, ".05").otherwise(" "),
    )
    return table(spark, folder, "customer").select(
        "c_custkey",
        t.branch_key(text).alias("branch_key"),
        t.branch_key(text, keep_zeros=True).alias("branch_key_zeros"),
        t.branch_without_f(text).alias("branch_without_f"),
        t.code_key(code).alias("code_key"),
        t.zero_pad2(branch).alias("padded"),
        t.to_number(text).alias("number"),
    )


def role_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Job titles of every customer reduced to a role."""
    segment, form = F.col("c_mktsegment"), F.col("c_custkey") % 4
    title = (
        F.when(form == 0, F.concat(F.lit("01 - "), segment))
        .when(form == 1, F.lower(segment))
        .when(form == 2, F.concat(F.lit("01 - A - "), segment))
        .otherwise(F.concat(F.lit("-"), F.lower(segment), F.lit(" ")))
    )
    return table(spark, folder, "customer").select("c_custkey", t.role_of(title).alias("role"))


def cpf_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Punctuated tax ids as digits, and short ones padded."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        t.tax_id(retail.punctuated(retail.cpf_of(key))).alias("cpf"),
        t.tax_id(key.cast("string"), pad=True).alias("padded"),
    )


def composite_id_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that more than one (branch, seller) pair of the sales shares."""
    pairs = retail.sale_lines(spark, folder).select("branch", "code")
    ids = pairs.withColumn("id", t.person_id(F.col("branch"), F.col("code")))
    return roster.id_collisions(ids)


# ---- periods -------------------------------------------------------------------------


def _order_days(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()


def reporting_period(spark: SparkSession, folder: str) -> DataFrame:
    """First and last day of the period reported on, for every order day."""
    day = F.col("day")
    return _order_days(spark, folder).select(
        "day",
        period.period_start(day).alias("period_start"),
        period.period_end(day).alias("period_end"),
    )


def days_left(spark: SparkSession, folder: str) -> DataFrame:
    """Days to the end of the month and next month's label, for every order day."""
    day = F.col("day")
    return _order_days(spark, folder).select(
        "day",
        period.days_left(day).cast("bigint").alias("days_left"),
        period.next_month_label(day).alias("next_month"),
    )


def _period_sales(spark: SparkSession, folder: str, as_of: str) -> DataFrame:
    parts = retail.hb_parts(spark, folder)
    lines_sold = retail.sale_lines(spark, folder).where(period.in_period(F.col("sold_at"), as_of))
    kept = lines_sold.join(parts, F.col("part_key") == F.col("p_partkey"), "left_semi")
    return kept.groupBy("branch").agg(
        F.count("*").alias("lines"), sum_money(F.col("amount")).alias("amount")
    )


def reporting_period_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Health-and-beauty sales of the period, excluded departments left out."""
    return _period_sales(spark, folder, AS_OF)


def reporting_period_sales_on_the_first(spark: SparkSession, folder: str) -> DataFrame:
    """The same on the first of a month: the whole month before."""
    return _period_sales(spark, folder, FIRST_OF_MONTH)


def hb_products_by_brand(spark: SparkSession, folder: str) -> DataFrame:
    """Products of the health-and-beauty group that count, per brand."""
    group = F.when(F.col("p_type") == retail.HB_TYPE, vocab.HB_PRODUCT_GROUP).otherwise("1")
    parts = table(spark, folder, "part").withColumn("group", group)
    kept = source_filters.hb_products(parts, "group", "p_size")
    return kept.groupBy("p_brand").agg(F.count("*").alias("products"))


def active_staff_by_branch(spark: SparkSession, folder: str) -> DataFrame:
    """People per branch without a date of dismissal, in all the ways it can be missing."""
    key = F.col("c_custkey") % 6
    left = F.when(key == 0, "01/02/2024").when(key == 1, " ").when(key == 2, "nan")
    staff = table(spark, folder, "customer").withColumn("Data de desligamento", left)
    active = source_filters.active_staff(staff)
    return active.groupBy("c_nationkey").agg(F.count("*").alias("people"))


# ---- sales and achieved --------------------------------------------------------------


def sales_by_seller(spark: SparkSession, folder: str) -> DataFrame:
    lines_sold = retail.sale_lines(spark, folder)
    return lines_sold.groupBy("code").agg(sum_money(F.col("amount")).alias("amount"))


def sales_by_branch_seller(spark: SparkSession, folder: str) -> DataFrame:
    return retail.seller_totals(spark, folder)


def _month(spark: SparkSession, folder: str, with_branches: bool = False) -> monthly.MonthTables:
    return retail.month_tables(spark, folder, retail.seller_mart(spark, folder), with_branches)


def _achieved(spark: SparkSession, tables: monthly.MonthTables) -> DataFrame:
    second = tabs.second_targets(tables.second_targets, spark)
    return sales.add_achieved(
        monthly.adjusted_roster(tables, second, spark),
        tabs.seller_sales(tables.seller_sales),
        second,
    )


def achieved_hybrid(spark: SparkSession, folder: str) -> DataFrame:
    """Achieved over all branches, or of the own branch for people with two targets."""
    return _achieved(spark, _month(spark, folder)).select("id", "branch", "code", "achieved")


def channel_share(spark: SparkSession, folder: str) -> DataFrame:
    """App-channel sales per branch and the share credited."""
    channel = retail.sale_lines(spark, folder).where(F.col("code") == retail.CHANNEL_CODE)
    totals = channel.groupBy("branch").agg(sum_money(F.col("amount")).alias("sales"))
    return totals.select("branch", "sales", t.channel_share(F.col("sales")).alias("share"))


def _credited(spark: SparkSession, tables: monthly.MonthTables) -> DataFrame:
    shares = tabs.channel_shares(tables.channel_sales, spark)
    return sales.add_channel_share(_achieved(spark, tables), shares)


def achieved_plus_share(spark: SparkSession, folder: str) -> DataFrame:
    credited = _credited(spark, _month(spark, folder))
    return credited.select("id", "branch", "code", "role", "achieved", "achieved_app")


def attainment(spark: SparkSession, folder: str) -> DataFrame:
    measured = payout.add_progress(_credited(spark, _month(spark, folder)))
    return measured.select(
        "id",
        "branch",
        "code",
        "target",
        "progress",
        t.percent_text(F.col("progress")).alias("progress_text"),
    )


PAYOUT_COLUMNS = (
    "id",
    "branch",
    "code",
    "role",
    "target",
    "achieved",
    "achieved_app",
    "progress",
    "accrued",
    "paid",
    "bonus",
    "total",
)


def seller_payout(spark: SparkSession, folder: str) -> DataFrame:
    """Payout from commissions, before the branch scorecard."""
    return monthly.close_month(_month(spark, folder), spark).calc.select(*PAYOUT_COLUMNS)


def seller_payout_on_achieved(spark: SparkSession, folder: str) -> DataFrame:
    """The same measured on plain achieved sales."""
    result = monthly.close_month(_month(spark, folder), spark, basis="achieved")
    return result.calc.select(*PAYOUT_COLUMNS)


def remaining_to_target(spark: SparkSession, folder: str) -> DataFrame:
    left = payout.add_remaining(_achieved(spark, _month(spark, folder)))
    return left.select(
        "id",
        "branch",
        "code",
        round2(F.col("remaining")).alias("remaining"),
        t.br_text_in_parentheses(F.col("remaining")).alias("remaining_text"),
    )


def daily_recommended(spark: SparkSession, folder: str) -> DataFrame:
    wanted = payout.add_daily_recommended(_achieved(spark, _month(spark, folder)), AS_OF)
    return wanted.select("id", "branch", "code", "daily_recommended")


def single_payout(spark: SparkSession, folder: str) -> DataFrame:
    """One payout figure per commission row of a person's own branch."""
    tables = _month(spark, folder)
    paid = payout.add_single_payout(
        _achieved(spark, tables), tabs.commissions(tables.commissions)
    )
    return paid.select("id", "branch", "code", "commission", "payout")


# ---- reports -------------------------------------------------------------------------


def _hb_rows(spark: SparkSession, folder: str) -> DataFrame:
    parts = retail.hb_parts(spark, folder)
    sold = retail.sale_lines(spark, folder).join(
        parts, F.col("part_key") == F.col("p_partkey"), "left_semi"
    )
    rows = sold.groupBy("branch", "code").agg(sum_money(F.col("amount")).alias("amount"))
    known = (F.col("branch") + F.col("code")) % 4 != 0
    name = F.concat(F.lit("V"), F.col("code").cast("string"), F.lit("/"), F.col("branch").cast("string"))
    return rows.select(
        "code",
        "amount",
        F.lit("hb").alias(FILE),
        F.col("branch").alias("row_idx"),
        F.when(known, name).alias("seller"),
    )


def hb_sales_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """HB sales per seller code, first known name kept, some codes left out."""
    totals = reports.hb_seller_totals(_hb_rows(spark, folder))
    return totals.select(
        "code", "seller", "amount", "rows", t.br_text_keep_zero_sign(F.col("amount")).alias("text")
    )


def hb_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return reports.duplicate_count(_hb_rows(spark, folder), "code")


def _printed(spark: SparkSession, folder: str, grid: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A report written as a table of cells, the way reports arrive."""
    # Grids read the sums twice, for the rows and for the titles.
    sold = staged(retail.monthly_sales(spark, folder), "monthly-sales")
    return staged(grid(sold), "report")


def flatten_sellers(spark: SparkSession, folder: str) -> DataFrame:
    return reports.seller_report(_printed(spark, folder, retail.seller_grid))


def flatten_hb_sellers(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hb_seller_report(_printed(spark, folder, retail.seller_grid))


def flatten_commissions(spark: SparkSession, folder: str) -> DataFrame:
    return reports.commission_report(_printed(spark, folder, retail.commission_grid))


def branch_totals_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.branch_totals(_printed(spark, folder, retail.branch_total_grid)).drop("row_idx")


def shift_channel_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.channel_report(_printed(spark, folder, retail.channel_grid))


def shift_pos_staff(spark: SparkSession, folder: str) -> DataFrame:
    return reports.pos_staff(retail.pos_staff_grid(spark, folder))


# ---- roster --------------------------------------------------------------------------


def _base(spark: SparkSession, folder: str) -> DataFrame:
    tab = retail.people_tab(retail.staff(spark, folder)).drop("CPF")
    return roster.build_roster(tab.toDF("branch", "code", "name", "title"))


def roster_base(spark: SparkSession, folder: str) -> DataFrame:
    return _base(spark, folder)


def _with_second(spark: SparkSession, folder: str) -> DataFrame:
    second = retail.second_targets_tab(retail.staff(spark, folder))
    return roster.add_second_targets(_base(spark, folder), tabs.second_targets(second, spark))


def roster_second_target(spark: SparkSession, folder: str) -> DataFrame:
    return _with_second(spark, folder)


def roster_leave_anti(spark: SparkSession, folder: str) -> DataFrame:
    on_leave = tabs.leave(retail.leave_tab(retail.staff(spark, folder)), spark)
    return roster.drop_on_leave(_with_second(spark, folder), on_leave)


def _written(spark: SparkSession, df: DataFrame, *order: str) -> DataFrame:
    """``df`` written as a table in a given order, and read back with its row numbers."""
    target = new_folder(spark, "table")
    snapshots.write_snapshot(df.orderBy(*order).drop("row_idx", *order), target, "1")
    return snapshots.latest_snapshot(spark, target, with_order=True)


def target_carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    """Targets typed into the last output, by id; the last filled one counts."""
    previous = retail.previous_tab(
        retail.staff(spark, folder), retail.seller_totals(spark, folder)
    )
    kept = tabs.previous_values(_written(spark, previous, "row_idx"), "Meta", spark)
    return roster.carry_forward(_with_second(spark, folder), kept, "target").select(
        "id", "branch", "code", "target_text", "target"
    )


def achieved_carry_forward(spark: SparkSession, folder: str) -> DataFrame:
    """The same for the achieved amount."""
    sold = retail.seller_totals(spark, folder)
    previous = sold.select(
        t.person_id(F.col("branch"), F.col("code")).alias("ID"),
        t.br_text(F.col("amount")).alias("Valor Realizado"),
        (F.col("code") * retail.BRANCHES + F.col("branch")).alias("row_idx"),
    )
    kept = tabs.previous_values(previous, "Valor Realizado", spark)
    return roster.carry_forward(_base(spark, folder), kept, "achieved").select(
        "id", "branch", "code", "achieved_text", "achieved"
    )


def remove_person(spark: SparkSession, folder: str) -> DataFrame:
    return roster.drop_person(_base(spark, folder), " supplier#000000002 ")


# ---- people --------------------------------------------------------------------------


def people_match(spark: SparkSession, folder: str) -> DataFrame:
    return people.match_people(retail.hr_list(spark, folder), retail.pos_list(spark, folder))


def people_match_stats(spark: SparkSession, folder: str) -> DataFrame:
    return people.match_stats(retail.hr_list(spark, folder), retail.pos_list(spark, folder))


def people_profile(spark: SparkSession, folder: str) -> DataFrame:
    matched = people_match(spark, folder).withColumns(
        {"branch": F.col("branch").cast("bigint"), "code": F.col("code").cast("bigint")}
    )
    return people.profile(matched, ["branch", "code"])


# ---- scorecard -----------------------------------------------------------------------


def _scorecard(spark: SparkSession, folder: str) -> DataFrame:
    branches = retail.branch_mart(spark, folder)
    sold = retail.seller_totals(spark, folder)
    return scorecard.build_scorecard(
        tabs.branch_sales(retail.branch_sales_tab(branches)),
        tabs.branch_targets(retail.branch_targets_tab(branches)),
        tabs.commissions(retail.commissions_tab(sold)),
    )


def branch_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue, HB revenue, cost and average ticket per branch."""
    return retail.branch_totals(spark, folder)


def _first_of_two(spark: SparkSession, tab: DataFrame) -> DataFrame:
    """A written table in which a second, later row of each branch must not count."""
    others = {c: F.lit("9,99") for c in tab.columns if c not in ("Filial", "row_idx")}
    first = tab.withColumn("version", F.lit(1))
    second = tab.withColumns(others).withColumn("version", F.lit(2))
    return _written(spark, first.unionByName(second), "version")


def branch_scorecard(spark: SparkSession, folder: str) -> DataFrame:
    """Scorecard from written tables that hold several rows for a branch."""
    branches = retail.branch_mart(spark, folder)
    card = scorecard.build_scorecard(
        tabs.branch_sales(_first_of_two(spark, retail.branch_sales_tab(branches))),
        tabs.branch_targets(_first_of_two(spark, retail.branch_targets_tab(branches))),
        tabs.commissions(retail.commissions_tab(retail.seller_totals(spark, folder))),
    )
    return card.withColumn("reward", scorecard.total_reward())


def payout_final(spark: SparkSession, folder: str) -> DataFrame:
    """The whole month: payout with managers and trainees paid from the scorecard."""
    result = monthly.close_month(_month(spark, folder, with_branches=True), spark)
    return result.calc.select(*PAYOUT_COLUMNS)


def manager_override(spark: SparkSession, folder: str) -> DataFrame:
    """Only the people the scorecard changes."""
    calc = monthly.close_month(_month(spark, folder, with_branches=True), spark).calc
    changed = roster.is_manager(F.col("role")) | F.col("is_trainee")
    return calc.where(changed).select(
        "id", "branch", "code", "role", "is_trainee", "accrued", "paid", "bonus", "total"
    )


def export_view(spark: SparkSession, folder: str) -> DataFrame:
    """The final table as users see it."""
    result = monthly.close_month(_month(spark, folder, with_branches=True), spark)
    return export.in_branch_order(export.calc_view(result.calc))


def scorecard_view(spark: SparkSession, folder: str) -> DataFrame:
    return export.in_branch_text_order(export.scorecard_view(_scorecard(spark, folder)))


def optional_tables_missing(spark: SparkSession, folder: str) -> DataFrame:
    """The month without any of its optional tables."""
    full = _month(spark, folder)
    bare = monthly.MonthTables(
        people=full.people, seller_sales=full.seller_sales, commissions=full.commissions
    )
    return monthly.close_month(bare, spark).calc.select(*PAYOUT_COLUMNS)


# ---- files ---------------------------------------------------------------------------


def hr_csv_union(spark: SparkSession, folder: str) -> DataFrame:
    """Staff of a folder of differing HR files, ready for export."""
    scan = hr_files.scan_hr_folder(spark, files.write_hr_folder(spark, folder))
    return hr_files.hr_export(scan.staff)


def hr_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Every reason for which a file is left out."""
    target = files.write_bad_hr_files(spark, folder)
    scan = hr_files.scan_hr_folder(spark, target, "part-*")
    return scan.rejected.select("label", "reason").distinct()


def grid_files_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Seller reports written as text files, scanned with numbered rows and flattened."""
    target = new_folder(spark, "grids")
    pages = staged(retail.monthly_sales(spark, folder), "monthly-sales").withColumn("page", F.floor(F.col("code") / 1000))
    files.print_grid(retail.seller_grid(pages, ["month", "page"]), target, 8)
    return reports.seller_report(grids.scan_grids(spark, target, "*", ";").cells)


def latest_report_file(spark: SparkSession, folder: str) -> DataFrame:
    """Of two versions of a report the one written last is read."""
    target = new_folder(spark, "versions")
    totals = retail.seller_mart(spark, folder)
    for version in (1, 2):
        rows = totals.withColumn("amount", F.col("amount") * version)
        files.write_csv(retail.seller_sales_tab(rows), f"{target}/{version}", sep=";")
    newest = latest.latest_reports(lines.list_files(spark, target, "*.csv")).first()
    tab = spark.read.options(header=True, sep=";").csv(newest["report"])
    return tabs.seller_sales(tab)


def snapshot_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs: the second keeps the targets found in the first one's newest snapshot."""
    target = new_folder(spark, "calc")
    tables = _month(spark, folder)
    first = monthly.close_month(tables, spark).calc
    snapshots.write_snapshot(export.calc_view(first), target, "9")
    grown = export.calc_view(first).withColumn(
        "Meta", F.when(F.col("Meta") != "", F.concat(F.lit("1"), F.col("Meta"))).otherwise("")
    )
    # Names do not tell the order: neither as text nor as numbers.
    for name, state in (("10", export.calc_view(first)), ("001", grown)):
        snapshots.write_snapshot(state, target, name)
    newest = snapshots.latest_snapshot(spark, target, with_order=True)
    kept = tabs.previous_values(newest, "Meta", spark)
    second = tabs.second_targets(tables.second_targets, spark)
    base = roster.add_second_targets(_base(spark, folder), second)
    return roster.carry_forward(base, kept, "target").select("id", "branch", "code", "target")


def export_text_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text as one-line export text, and missing values beside it."""
    texts = F.array(F.concat(F.lit('"\t'), F.col("text")), F.lit("nan"), F.lit(None).cast("string"))
    documents = table(spark, folder, "documents").select("doc_id", F.posexplode(texts).alias("variant", "shown"))
    return documents.select("doc_id", "variant", t.export_text(F.col("shown")).alias("clean"))


def blank_missing_values(spark: SparkSession, folder: str) -> DataFrame:
    """Every event's amount as text, and missing amounts as blank cells."""
    amounts = F.array(
        F.col("value"), F.lit(float("nan")), F.lit(float("inf")), F.lit(None).cast("double")
    )
    events = table(spark, folder, "events").select(
        "event_id", F.posexplode(amounts).alias("variant", "amount")
    )
    return snapshots.blank_missing(columns.in_order(events, ["event_id", "variant", "amount", "note"]))


ALL: dict[str, Query] = {
    q.__name__: q
    for q in (
        br_number_parse,
        br_number_format,
        quantity_format,
        percent_text,
        branch_code_keys,
        role_extract,
        cpf_clean,
        composite_id_collisions,
        reporting_period,
        days_left,
        reporting_period_sales,
        reporting_period_sales_on_the_first,
        hb_products_by_brand,
        active_staff_by_branch,
        sales_by_seller,
        sales_by_branch_seller,
        achieved_hybrid,
        channel_share,
        achieved_plus_share,
        attainment,
        seller_payout,
        seller_payout_on_achieved,
        remaining_to_target,
        daily_recommended,
        single_payout,
        hb_sales_dedup,
        hb_duplicates,
        flatten_sellers,
        flatten_hb_sellers,
        flatten_commissions,
        branch_totals_report,
        shift_channel_report,
        shift_pos_staff,
        roster_base,
        roster_second_target,
        roster_leave_anti,
        target_carry_forward,
        achieved_carry_forward,
        remove_person,
        people_match,
        people_match_stats,
        people_profile,
        branch_figures,
        branch_scorecard,
        payout_final,
        manager_override,
        export_view,
        scorecard_view,
        optional_tables_missing,
        hr_csv_union,
        hr_csv_rejects,
        grid_files_scan,
        latest_report_file,
        snapshot_roundtrip,
        export_text_clean,
        blank_missing_values,
    )
}
