"""Queries over what keeps a workspace sound: quarantine, commits, ledgers, checks and sketches."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from balcao.functions import text as t
from balcao.functions.tax_ids import check_digit
from balcao.operators import contracts, dated_rules, lineage, people, previews, roster
from balcao.operators.ordered import FILE
from balcao.catalogue import retail
from balcao.plans import monthly
from balcao.catalogue.files import write_hr_folder
from balcao.catalogue.queries import PAYOUT_COLUMNS, Query, people_match
from balcao.catalogue.retail import table
from balcao.sources import hr_files, sketches, snapshots, tabs
from balcao.sources.ledger import Ledger, Loaded
from balcao.sources.maintained import MaintainedSums
from balcao.sources.staging import new_folder, staged


# ---- rows set aside ------------------------------------------------------------------


def _faulty_month(spark: SparkSession, folder: str, with_branches: bool) -> monthly.MonthTables:
    """The month's tables with keys and percentages that cannot be read."""
    tables = retail.month_tables(spark, folder, retail.seller_mart(spark, folder), with_branches)
    number = F.col("CPF").cast("bigint")
    people = tables.people.withColumns(
        {
            "Filial": F.when(number % 19 == 5, "MATRIZ").otherwise(F.col("Filial")),
            "Código": F.when(number % 23 == 7, F.concat(F.lit("A"), "Código")).otherwise(F.col("Código")),
        }
    )
    other = F.regexp_extract("Colaborador", "([0-9]+)$", 1).cast("bigint") % 20 == 14
    second = tables.second_targets.withColumn("Filial", F.when(other, "1.5").otherwise(F.col("Filial")))
    targets = tables.branch_targets
    if targets is not None:
        targets = targets.withColumn("CMV", F.when(F.col("Filial") == "9", "n/d").otherwise(F.col("CMV")))
    return monthly.replace(tables, people=people, second_targets=second, branch_targets=targets)


def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the month cannot use, with column, value and reason."""
    found = monthly.close_month(_faulty_month(spark, folder, True), spark, quarantine=True).quarantine
    who = F.coalesce(*[F.get_json_object("row", f"$.{c}") for c in ("Nome", "Colaborador", "Filial")])
    return found.select("table", "column", "value", "reason", who.alias("who"))


def payout_without_quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """Payouts of the rows that are left."""
    result = monthly.close_month(_faulty_month(spark, folder, False), spark, quarantine=True)
    return result.calc.select(*PAYOUT_COLUMNS)


# ---- commits -------------------------------------------------------------------------


def atomic_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Two writers start from one version: the first replaces the table, the second gets an error."""
    target = new_folder(spark, "replaced")
    sold = retail.seller_mart(spark, folder)
    snapshots.write_snapshot(sold, target, "r1")
    base = snapshots.newest_version(spark, target)
    outcomes = []
    for name, factor in (("r2", 2), ("r3", 3)):
        try:
            snapshots.write_snapshot(sold.withColumn("amount", F.col("amount") * factor), target, name, base=base)
            outcomes.append("committed")
        except snapshots.LostRace:
            outcomes.append("lost")
    return snapshots.latest_snapshot(spark, target).withColumns(
        {
            "first_writer": F.lit(outcomes[0]),
            "second_writer": F.lit(outcomes[1]),
            "version": F.lit(snapshots.newest_version(spark, target)).cast("bigint"),
        }
    )


def snapshot_retention(spark: SparkSession, folder: str) -> DataFrame:
    """The table after old snapshots were deleted, and how many were."""
    target = new_folder(spark, "retained")
    sold = retail.seller_mart(spark, folder)
    for step in range(1, 6):  # the third is empty and replaces nothing
        rows = sold.where(F.lit(step != 3)).withColumn("amount", F.col("amount") * step)
        snapshots.write_snapshot(rows, target, f"r{step}")
    gone = snapshots.expire_snapshots(spark, target, keep=2, keep_seconds=0)
    return snapshots.latest_snapshot(spark, target).withColumn("expired", F.lit(len(gone)).cast("bigint"))


# ---- ledger --------------------------------------------------------------------------


def _write_staff_files(staff: DataFrame, target: str) -> None:
    """One directory of part files for each branch; those already there are replaced."""
    file = F.concat(F.lit("Colaboradores - "), retail.two_digits(F.col("branch")), F.lit(".csv"))
    named = staff.withColumn(FILE, file).drop("branch")
    ordered = named.repartition(FILE).sortWithinPartitions(FILE, "CPF")
    ordered.write.partitionBy(FILE).options(header=True, sep=";", partitionOverwriteMode="dynamic").mode("overwrite").csv(target)


def _reloaded(spark: SparkSession, folder: str) -> tuple[Ledger, list[Loaded]]:
    """A folder of staff files loaded three times while files are added, changed and written anew."""
    staff = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("branch"), retail.cpf_of(F.col("c_custkey")).alias("CPF"), F.col("c_name").alias("Nome")
    )
    target = new_folder(spark, "staff-files")
    ledger = Ledger(spark, new_folder(spark, "staff"))

    def load(run: str) -> Loaded:
        return ledger.load(
            target, hr_files.CSV, run, lambda s, places: hr_files.scan_hr_folder(s, places, with_file=True).staff
        )

    _write_staff_files(staff.where("branch <> 24"), target)
    runs = [load("r1"), load("r2")]
    changed = staff.where("branch % 5 = 0").withColumn("Nome", F.concat("Nome", F.lit("!")))
    _write_staff_files(changed.unionByName(staff.where("branch in (3, 24)")), target)
    runs.append(load("r3"))
    ledger.compact("r4")
    return ledger, runs


def staff_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Staff after the folder was loaded several times: the same as after one fresh load."""
    ledger, _ = _reloaded(spark, folder)
    return ledger.table().select("Filial", "CPF", "Nome")


def staff_ledger_runs(spark: SparkSession, folder: str) -> DataFrame:
    """What each run found, counted by what became of a file."""
    _, runs = _reloaded(spark, folder)
    rows = [(i, r.new, r.changed, r.touched, r.unchanged, r.gone) for i, r in enumerate(runs, 1)]
    return spark.createDataFrame(rows, "run bigint, new bigint, changed bigint, touched bigint, unchanged bigint, gone bigint")


# ---- maintained sums -----------------------------------------------------------------


def maintained_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after monthly reports were issued, issued again with other sums, and withdrawn."""
    rows = retail.monthly_sales(spark, folder).select(
        F.col("month").alias("report"),
        F.col("branch").cast("string").alias("branch_key"),
        F.col("code").cast("string").alias("code_key"),
        "amount",
    )
    rows = staged(rows, "monthly-reports")
    sums = MaintainedSums(spark, new_folder(spark, "maintained"))
    early = F.col("report") < "1998"
    sums.issue(rows.where(early))
    sums.issue(rows.where(~early))
    again = rows.where(F.col("report").endswith("-03") & (F.col("branch_key") != "3"))
    sums.issue(again.withColumn("amount", F.col("amount") * 2))
    sums.withdraw(rows.where("report in ('1996-05', '1999-03')").select("report"))
    return sums.totals()


# ---- people --------------------------------------------------------------------------


def _with_check_digits(nine: Column) -> Column:
    """A made-up tax id: nine digits and the two that follow from them."""
    first = F.concat(nine, check_digit(nine, 10).cast("string"))
    return F.concat(first, check_digit(first, 11).cast("string"))


def tax_id_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Ids whose zeros were cut off get them back; wrong and valid ones stay as they are."""
    key = F.col("c_custkey")
    whole = _with_check_digits(F.lpad((key * 7919 % 1_000_000_000).cast("string"), 9, "0"))
    last = F.substring(whole, 11, 1).cast("int")
    text = (
        F.when(key % 5 == 0, retail.punctuated(whole))
        .when(key % 5 == 1, F.ltrim(whole, F.lit("0")))
        .when(key % 5 == 2, F.concat(F.substring(whole, 1, 10), (F.lit(9) - last).cast("string")))
        .when(key % 5 == 3, F.lit("sem CPF"))
        .otherwise(whole)
    )
    rows = table(spark, folder, "customer").select("c_custkey", text.alias("written"), text.alias("cpf"))
    return people.repaired_tax_ids(rows)


def people_first_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten tax ids of each side and of both."""
    return previews.first_ids(retail.hr_list(spark, folder), retail.pos_list(spark, folder))


def people_first_values(spark: SparkSession, folder: str) -> DataFrame:
    """The first five filled values of every column of the matched people."""
    found = people_match(spark, folder).withColumns(
        {"branch": F.col("branch").cast("bigint"), "code": F.col("code").cast("bigint")}
    )
    title = F.when(F.col("branch") == 0, " ").otherwise(F.col("title"))  # blanks are no samples
    return previews.first_values(found.withColumn("title", title), ["branch", "code"])


def _places(rows: DataFrame, order: str) -> DataFrame:
    """For each branch of a written table its place among the branches, its rows, and how many
    of them stand before one that should come first."""
    inside = Window.partitionBy("branch").orderBy("row_idx")
    wrong = F.coalesce(F.lag(order).over(inside) > F.col(order), F.lag(order).over(inside).isNull() & F.lag("row_idx").over(inside).isNotNull() & F.col(order).isNotNull())
    per_branch = rows.withColumn("wrong", F.coalesce(wrong, F.lit(False))).groupBy("branch").agg(
        F.min("row_idx").alias("first"), F.max("row_idx").alias("last"),
        F.count(F.lit(1)).alias("rows"), F.count_if("wrong").alias("misplaced"),
    )
    # One row for each branch from here on.
    one = Window.partitionBy(F.lit(1)).orderBy("first")
    return per_branch.select(
        "branch", F.row_number().over(one).cast("bigint").alias("place"), "rows", "misplaced",
        F.coalesce(F.lag("last").over(one) < F.col("first"), F.lit(True)).alias("apart"),
    )


def people_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Matched people as written: by branch and code as numbers, what is no number last."""
    junk = F.when(F.col("code") % 97 == 0, F.concat(F.lit("x"), "code")).otherwise(F.col("code"))
    found = people_match(spark, folder).withColumns(
        {"branch": F.when(F.col("branch") == "4", "MATRIZ").otherwise(F.col("branch")), "code": junk}
    )
    target = new_folder(spark, "people")
    snapshots.write_snapshot(found.orderBy(*people.people_order()), target, "1")
    written = snapshots.latest_snapshot(spark, target, with_order=True)
    return _places(written.withColumn("number", F.col("code").try_cast("bigint")), "number")


def staff_in_branch_order(spark: SparkSession, folder: str) -> DataFrame:
    """The HR table as written: by branch as a number, shown as text."""
    staff = hr_files.scan_hr_folder(spark, write_hr_folder(spark, folder)).staff
    target = new_folder(spark, "staff")
    snapshots.write_snapshot(hr_files.hr_export(staff.orderBy("Filial")), target, "1")
    written = snapshots.latest_snapshot(spark, target, with_order=True)
    return _places(written.select(F.col("Filial").alias("branch"), "row_idx", F.lit(0).alias("number")), "number")


# ---- tables --------------------------------------------------------------------------


def tab_read(spark: SparkSession, folder: str) -> DataFrame:
    """A list of branches as kept by hand, with blanks in headings and between rows, read as text."""
    target = new_folder(spark, "tab")
    branches = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    marked = F.when(F.col("c_nationkey") % 3 == 0, "").otherwise("x")
    quoted = F.concat(F.lit('"loja; ""'), "c_nationkey", F.lit('"""'))
    row = F.concat_ws(";", F.concat(F.lit(" "), "c_nationkey"), quoted, F.col("n").cast("string"), marked)
    blank = F.when(F.col("c_nationkey") % 4 == 0, F.lit(" ; ;"))
    rows = branches.select("c_nationkey", F.posexplode(F.array_compact(F.array(row, blank))).alias("at", "value"))
    head = branches.agg(F.min("c_nationkey")).select(
        F.lit(-1).alias("c_nationkey"), F.lit(0).alias("at"), F.lit(' ID ;"Nome ";Clientes;Marca').alias("value")
    )
    # Two rows for each branch at most: one file, as such lists are.
    ordered = rows.unionByName(head).repartition(1).sortWithinPartitions("c_nationkey", "at")
    ordered.select("value").write.text(target)
    return tabs.read_tab(spark, target).drop("row_idx")


def empty_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Empty results written over a table in each way: none replaces it, one is an error."""
    target = new_folder(spark, "guarded")
    sold = retail.seller_mart(spark, folder)
    outcomes = [str(snapshots.write_snapshot(sold, target, "full"))]
    outcomes.append(str(snapshots.write_snapshot(sold.where("false"), target, "skipped")))
    try:
        snapshots.write_snapshot(sold.where("false"), target, "refused", if_empty="fail")
    except snapshots.EmptyOutput:
        outcomes.append("refused")
    header = snapshots.latest_snapshot(spark, target, even_if_empty=True)
    return snapshots.latest_snapshot(spark, target).withColumns(
        {"outcomes": F.lit(" ".join(outcomes)), "header": F.lit(" ".join(header.columns))}
    )


def required_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Each table without one of its columns: refused, or taken as absent, with the rows it has."""
    tables = retail.month_tables(spark, folder, retail.seller_mart(spark, folder))
    readers = {
        "VENDAS_VENDEDOR": (tables.seller_sales, "Valor Vendas", lambda tab: tabs.seller_sales(tab)),
        "COMISSOES": (tables.commissions, "Valor Comissão", lambda tab: tabs.commissions(tab)),
        "VENDAS_FILIAL": (tables.branch_sales, "Custo Total", lambda tab: tabs.branch_sales(tab)),
        "META_FILIAL": (tables.branch_targets, "CMV", lambda tab: tabs.branch_targets(tab)),
        "TRAINEES": (tables.trainees, "Colaborador", lambda tab: tabs.trainees(tab, spark)),
        "2_META": (tables.second_targets, "Filial", lambda tab: tabs.second_targets(tab, spark)),
        "AFASTAMENTOS": (tables.leave, "Colaborador", lambda tab: tabs.leave(tab, spark)),
        "VENDAS_548": (tables.channel_sales, "40% VT", lambda tab: tabs.channel_shares(tab, spark)),
    }
    parts = []
    for name, (tab, column, read) in readers.items():
        try:
            left = read(tab.drop(column))
            outcome = "absent"
        except ValueError as error:
            left, outcome = tab.where("false"), str(error)
        sides = tab.select(F.lit(False).alias("after")).unionByName(left.select(F.lit(True).alias("after")))
        counts = sides.agg(F.count_if(~F.col("after")).alias("rows"), F.count_if("after").alias("read"))
        parts.append(counts.select(F.lit(name).alias("table"), F.lit(outcome).alias("outcome"), "rows", "read"))
    return reduce(DataFrame.unionByName, parts)


# ---- contracts and lineage -----------------------------------------------------------


def contract_checks(spark: SparkSession, folder: str) -> DataFrame:
    """All rules of the workspace's tables, with values, keys and references broken on purpose."""
    tables = retail.month_tables(spark, folder, retail.seller_mart(spark, folder))
    number = F.col("CPF").cast("bigint")
    known = tables.people.where(number % 37 != 2)
    code = F.col("Código").try_cast("double").cast("bigint")
    priced = F.when(code % 29 == 3, "x").otherwise(F.col("Valor Vendas"))
    given = {
        "filtered_user": known.unionByName(known.where(number % 31 == 1)),
        "VENDAS_VENDEDOR": tables.seller_sales.withColumn("Valor Vendas", priced),
        "COMISSOES": tables.commissions,
        "VENDAS_FILIAL": tables.branch_sales.unionByName(tables.branch_sales.where("Filial = 'F03'")),
        "META_FILIAL": tables.branch_targets.withColumn(
            "CMV", F.when(F.col("Filial") == "9", "n/d").otherwise(F.col("CMV"))
        ),
        "VENDAS_548": tables.channel_sales,
        "TRAINEES": tables.trainees,
        "2_META": tables.second_targets,
        "AFASTAMENTOS": tables.leave,
    }
    found = contracts.check_contracts(given, contracts.WORKSPACE_RULES, spark)
    return found.withColumn("shown", F.array_join("shown", ", "))


def dropped_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What became of every row of every report: outcomes add up to the rows read."""
    sold = staged(retail.monthly_sales(spark, folder), "monthly-sales")
    grids = {
        "sellers": retail.seller_grid(sold),
        "commissions": retail.commission_grid(sold),
        "branch_totals": retail.branch_total_grid(sold),
        "channel": retail.channel_grid(sold),
        "pos_staff": retail.pos_staff_grid(spark, folder),
    }

    def judged(kind: str) -> DataFrame:
        return lineage.judged_rows(kind, staged(grids[kind], "report"))

    # Reports do not wait for each other: the last tasks of one leave cores to the next.
    with ThreadPoolExecutor(len(grids)) as pool:
        found = dict(zip(grids, pool.map(judged, grids)))
    parts = [lineage.drop_report(rows, kind).drop("first_row") for kind, rows in found.items()]
    return reduce(DataFrame.unionByName, parts)


def people_left_out(spark: SparkSession, folder: str) -> DataFrame:
    """Why people and second targets do not reach the month."""
    tab = retail.people_tab(retail.staff(spark, folder)).drop("CPF")
    base = roster.build_roster(tab.toDF("branch", "code", "name", "title"))
    second = tabs.second_targets(retail.second_targets_tab(retail.staff(spark, folder)), spark)
    targets = lineage.judged_second_targets(base, second).withColumn("side", F.lit("2_META"))
    matched = lineage.judged_people(retail.hr_list(spark, folder), retail.pos_list(spark, folder))
    return lineage.outcome_counts(targets, "second_targets", "side").unionByName(
        lineage.outcome_counts(matched, "match_people", "side")
    )


# ---- sketches ------------------------------------------------------------------------


def key_overlap_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct tax ids of two written tables and of both, exact, and whether sketches agree."""
    sides = {"hr": retail.hr_list(spark, folder), "pos": retail.pos_list(spark, folder)}
    column = {"hr": "Nº CPF", "pos": "CPF"}
    kept = {}
    for side, df in sides.items():
        target = new_folder(spark, f"sketched-{side}")
        snapshots.write_snapshot(df, target, "1")
        sketches.store_sketches(spark, target, {"cpf": t.tax_id(F.col(f"`{column[side]}`"))})
        kept[side] = sketches.stored_sketches(spark, target)
    guessed = sketches.overlap(kept["hr"], "cpf", kept["pos"], "cpf")
    exact = people.match_stats(sides["hr"], sides["pos"])
    both = exact.withColumn("one", F.lit(1)).join(guessed.withColumn("one", F.lit(1)), "one")  # one row each
    # Three standard errors; an overlap's is larger by the root of union over overlap.
    allowed = F.lit(3 * sketches.standard_error())
    wider = allowed * F.sqrt(F.col("either") / F.greatest("both", F.lit(1)))
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("side"), F.col(ids).alias("ids"), (F.abs(F.col(guess) - F.col(ids)) <= error * F.col(ids)).alias("within"))
            for name, ids, guess, error in (
                ("hr", "hr_ids", "left", allowed),
                ("pos", "pos_ids", "right", allowed),
                ("both", "common_ids", "both", wider),
            )
        ]
    )
    return both.select(F.inline(rows))


# ---- dated rules ---------------------------------------------------------------------


def payout_by_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The whole month with today's steps and rates read from rows."""
    tables = retail.month_tables(spark, folder, retail.seller_mart(spark, folder))
    rules = dated_rules.todays_rules(spark)
    later = dt.date(2001, 1, 1)
    ended = rules.withColumn("valid_to", F.lit(later))
    changed = rules.withColumns({"valid_from": F.date_add(F.lit(later), 1), "amount": F.col("amount") * 2})
    result = monthly.close_month(tables, spark, rules=ended.unionByName(changed), as_of=dt.date(2000, 6, 20))
    return result.calc.select(*PAYOUT_COLUMNS)


def dated_order_bonus(spark: SparkSession, folder: str) -> DataFrame:
    """A bonus on every order by the rules of its day, which change within a year and a month."""
    steps = [
        ("order", dt.date(1900, 1, 1), dt.date(1996, 6, 15), 100_000.0, 10.0),
        ("order", dt.date(1900, 1, 1), dt.date(1996, 6, 15), 200_000.0, 25.0),
        ("order", dt.date(1996, 6, 16), None, 150_000.0, 20.0),
        ("order", dt.date(1997, 1, 1), dt.date(1997, 12, 31), 50_000.0, 5.0),
    ]
    rules = dated_rules.checked(spark.createDataFrame(steps, dated_rules.SCHEMA))
    orders = table(spark, folder, "orders").select("o_orderdate", "o_totalprice")
    paid = dated_rules.add_amounts(orders, rules, [("order", "o_totalprice", "bonus")], F.col("o_orderdate"))
    return paid.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.count("bonus").alias("with_bonus"), F.sum("bonus").alias("bonus")
    )


ALL: dict[str, Query] = {
    q.__name__: q
    for q in (
        quarantined_rows,
        payout_without_quarantined,
        atomic_replace,
        snapshot_retention,
        staff_ledger,
        staff_ledger_runs,
        maintained_sums,
        tax_id_repair,
        people_first_ids,
        people_first_values,
        people_in_order,
        staff_in_branch_order,
        tab_read,
        empty_guard,
        required_columns,
        contract_checks,
        dropped_rows,
        people_left_out,
        key_overlap_sketches,
        payout_by_rules,
        dated_order_bonus,
    )
}
