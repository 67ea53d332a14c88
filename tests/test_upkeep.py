"""Quarantine, commits, ledgers, maintained sums, previews and check digits against plain loops."""

import datetime as dt
import json
import os
import random
import threading
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from balcao.functions import tax_ids
from balcao.operators import contracts, dated_rules, lineage, people, previews, quarantine, reports
from balcao.plans.monthly import MonthTables, close_month
from balcao.plans.workspace import Workspace
from balcao.sources import hr_files, sketches, snapshots
from balcao.sources.commits import Commit, CommitLog, LostRace
from balcao.sources.ledger import Ledger
from balcao.sources.maintained import MaintainedSums
from tests.conftest import rows
from tests.test_workspace import chain, write_csv  # noqa: F401


# ---- quarantine ----------------------------------------------------------------------

PEOPLE = "Filial string, `Código` string, Nome string, `Cargo atual` string, CPF string"


def test_split_keeps_every_row_in_one_part(spark, frame):
    values = [("F01", "20.0"), ("MATRIZ", "21"), ("2", "A1"), ("x", ""), (None, "5"), ("3", None), (" 4 ", " 7 "), ("9" * 30, "1")]
    df = frame(PEOPLE, *[(b, c, f"p{i}", "GERENTE", "") for i, (b, c) in enumerate(values)])
    good, bad = quarantine.split(df, "filtered_user", quarantine.MONTH_CHECKS["filtered_user"])
    assert good.columns == df.columns and rows(good, "Nome") == [("p0",), ("p6",)]
    faults = {(json.loads(r.row)["Nome"], r.column, r.value) for r in bad.collect()}
    assert faults == {
        ("p1", "Filial", "MATRIZ"), ("p2", "Código", "A1"), ("p3", "Filial", "x"), ("p3", "Código", ""),
        ("p4", "Filial", None), ("p5", "Código", None), ("p7", "Filial", "9" * 30),
    }
    assert {r.reason for r in bad.collect()} == {"not a branch number", "not a seller code"}
    assert good.count() + bad.select("row_idx").distinct().count() == len(values)


def test_the_input_is_computed_once(spark, frame):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = frame("Filial string, n int", *[("1" if i % 3 else "?", i) for i in range(30)])
    good, bad = quarantine.split(df.mapInArrow(count, df.schema), "t", [quarantine.BRANCH])
    assert (good.count(), bad.count(), good.count()) == (20, 10, 20) and seen.value == 30


def test_split_without_faults_rows_or_columns(frame):
    df = frame("a string, row_idx bigint", ("x", 7))
    good, bad = quarantine.split(df, "t", [quarantine.BRANCH])
    assert rows(good) == [("x", 7)] and bad.isEmpty() and tuple(bad.columns) == quarantine.COLUMNS
    good, bad = quarantine.split(df.where("false"), "t", [quarantine.BRANCH])
    assert good.isEmpty() and bad.isEmpty()


def month(frame, spark):
    people_rows = frame(PEOPLE, ("1", "20", "ANA", "GERENTE", "1"), ("MATRIZ", "21", "BIA", "FARMACEUTICO", "2"), ("2", "22", "CAIO", "FARMACEUTICO", "3"), ("?", "9", "DUDA", "FAXINA", "4"))
    return MonthTables(
        people=people_rows,
        seller_sales=frame("Filial string, `Código` string, `Valor Vendas` string", ("2", "22", "10,00")),
        commissions=frame("Filial string, `Código` string, `Valor Comissão` string", ("2", "22", "1,00")),
        branch_sales=frame("Filial string, `Faturamento HB` string, `Custo Total` string, `Faturamento Total` string, `Ticket Médio` string, row_idx bigint", ("2", "1,00", "1,00", "10,00", "1,00", 0)),
        branch_targets=frame("Filial string, Number string, HB string, `TKT MÉDIO` string, CMV string, row_idx bigint", ("2", "1,00", "1,00", "1,00", "junk", 0), ("1", "1,00", "1,00", "1,00", "5%", 1)),
        second_targets=frame("ID string, Filial string, `Código` string, Colaborador string", ("322", "3", "22", "CAIO"), ("x22", "x", "22", "CAIO")),
    )


def test_close_month_sets_rows_aside(frame, spark):
    tables = month(frame, spark)
    with pytest.raises(Exception, match="not a (branch number|percentage)"):
        close_month(tables, spark).calc.collect()
    result = close_month(tables, spark, quarantine=True)
    assert rows(result.calc, "id", "achieved") == [("120", None), ("222", 10.0), ("322", None)]
    assert rows(result.quarantine, "table", "column", "value") == [
        ("2_META", "Filial", "x"), ("META_FILIAL", "CMV", "junk"), ("filtered_user", "Filial", "?"), ("filtered_user", "Filial", "MATRIZ")
    ]
    assert rows(result.scorecard, "branch_key", "cost_reward") == [("2", None)]


def test_commissions_of_unreadable_branches(frame):
    head = ["Código", "Vendedor", "Base Comissão", "% Comissão", "Valor Comissão"]
    lines = [*[["x"] * 5] * 10, head, ["Filial:", "1", "", "", ""], ["20", "ANA", "1", "1", "5,00"], ["Filial:", "LOJA", "", "", ""], ["21", "BIA", "1", "1", "7,00"]]
    cells = frame("file string, row_idx bigint, cells array<string>", *[("f", i, line) for i, line in enumerate(lines)])
    with pytest.raises(Exception, match="not a branch number"):
        reports.commission_report(cells).collect()
    good, bad = reports.split_commission_report(cells)
    assert rows(good, "Filial", "Código") == [("01", "20")]
    assert rows(bad, "table", "column", "value") == [("COMISSOES", "Filial", "LOJA")]


def test_workspace_quarantine(spark, chain):  # noqa: F811
    inbox, shop = chain / "inbox", Workspace(spark, str(chain / "shop"))
    for kind, folder in (("sellers", "sellers"), ("commissions", "commissions"), ("pos_staff", "staff")):
        assert shop.load_report(kind, str(inbox / folder), "1", quarantine=True)
    write_csv(inbox / "hr" / "COLABORADORES - 03.csv", [["CPF", "Cargo atual"], ["44444444444", "FARMACEUTICO"]])
    shop.load_hr(str(inbox / "hr"), "1")
    assert shop.match_people("1")
    write_csv(chain / "shop" / "manual" / "2_META.csv", [["ID", "Filial", "Código", "Colaborador"], ["x20", "x", "20", "ANA"]], ",")
    with pytest.raises(Exception, match="not a branch number"):
        shop.close("1")
    assert shop.close("2", quarantine=True)
    assert rows(shop.table("quarantine"), "table", "value") == [("2_META", "x")]
    assert shop.table("quarantine_COMISSOES").isEmpty()


# ---- commits -------------------------------------------------------------------------


def test_one_of_two_writers_wins(spark, tmp_path, frame):
    folder = str(tmp_path / "t")
    snapshots.write_snapshot(frame("a string", ("old",)), folder, "0")
    base = snapshots.newest_version(spark, folder)
    assert snapshots.write_snapshot(frame("a string", ("x",)), folder, "1", base=base)
    with pytest.raises(LostRace, match="another writer"):
        snapshots.write_snapshot(frame("a string", ("y",)), folder, "2", base=base)
    assert rows(snapshots.latest_snapshot(spark, folder)) == [("x",)]
    assert len([n for n in os.listdir(folder) if n.startswith("snapshot=")]) == 2  # the loser's data is gone
    assert not [n for n in os.listdir(f"{folder}/_commits") if not n.strip(".").startswith("0")]


def test_claims_at_the_same_moment(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    start, outcomes = threading.Barrier(8), []

    def claim(i):
        start.wait()
        try:
            log.claim(Commit(1, f"w{i}", 1, 0, f"d{i}"))
            outcomes.append(i)
        except LostRace:
            outcomes.append(None)

    threads = [threading.Thread(target=claim, args=(i,)) for i in range(8)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    (winner,) = [o for o in outcomes if o is not None]
    assert len(outcomes) == 8 and log.numbers() == [1] and log.read(1).name == f"w{winner}"


def test_unfinished_data_is_never_read(spark, tmp_path, frame):
    folder = str(tmp_path / "t")
    snapshots.write_snapshot(frame("a string", ("x",)), folder, "1")
    frame("a string", ("half",)).write.parquet(f"{folder}/snapshot=2~feed")
    assert rows(snapshots.latest_snapshot(spark, folder)) == [("x",)]
    with pytest.raises(FileExistsError):
        snapshots.write_snapshot(frame("a string", ("y",)), folder, "2")
    with pytest.raises(snapshots.NoSnapshot):
        snapshots.latest_snapshot(spark, str(tmp_path / "nothing"))


def test_retention(spark, tmp_path, frame):
    folder = str(tmp_path / "t")
    full = frame("a string", ("x",))
    for i in range(5):
        snapshots.write_snapshot(full.where(F.lit(i != 4)).withColumn("a", F.lit(f"v{i}")), folder, str(i))
    full.write.parquet(f"{folder}/snapshot=left~1")
    assert snapshots.expire_snapshots(spark, folder) == []  # all is young
    time.sleep(0.1)
    gone = snapshots.expire_snapshots(spark, folder, keep=2, keep_seconds=0.05)
    assert sorted(n.split("~")[0] for n in gone) == ["snapshot=0", "snapshot=1", "snapshot=left"]
    assert CommitLog(spark, folder).numbers() == [5, 4, 3]  # the newest is empty and stays
    assert rows(snapshots.latest_snapshot(spark, folder)) == [("v3",)]
    snapshots.write_snapshot(full, folder, "5")
    assert CommitLog(spark, folder).newest() == 6


def test_two_closes_from_one_calc_table(spark, chain):  # noqa: F811
    inbox, shop = chain / "inbox", Workspace(spark, str(chain / "shop"))
    for kind, folder in (("sellers", "sellers"), ("commissions", "commissions"), ("pos_staff", "staff")):
        assert shop.load_report(kind, str(inbox / folder), "1")
    shop.load_hr(str(inbox / "hr"), "1")
    assert shop.match_people("1")
    tables = shop.month_tables

    def meanwhile():
        shop.month_tables = tables
        assert shop.close("other")
        return tables()

    shop.month_tables = meanwhile
    with pytest.raises(LostRace):
        shop.close("mine")
    assert set(shop.expire(1, 0)) <= {"calc", "META_GERENTE"}


# ---- ledger --------------------------------------------------------------------------

HEAD = "CPF;Nome;Cargo atual\n"


class Folder:
    def __init__(self, spark, path):
        self.spark, self.path, self.ledger = spark, path / "in", Ledger(spark, str(path / "table"))
        self.path.mkdir()
        self.read = []

    def write(self, branch, *names, when=None):
        path = self.path / f"Colaboradores - {branch}.csv"
        path.write_text(HEAD + "".join(f"{i};{name};X\n" for i, name in enumerate(names)))
        if when:
            os.utime(path, (when, when))

    def load(self, run, **options):
        def scan(spark, places):
            self.read.append(sorted(os.path.basename(p) for p in places) if isinstance(places, list) else "all")
            return hr_files.scan_hr_folder(spark, places, with_file=True).staff

        self.read = []
        found = self.ledger.load(str(self.path), hr_files.CSV, run, scan, **options)
        return {k: v for k, v in vars(found).items() if v}

    def matches_a_fresh_load(self):
        fresh = hr_files.scan_hr_folder(self.spark, str(self.path)).staff
        return rows(self.ledger.table(), "Filial", "CPF", "Nome") == rows(fresh, "Filial", "CPF", "Nome")


def test_ledger(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    assert folder.ledger.table().isEmpty()
    for branch in (1, 2, 3):
        folder.write(branch, f"a{branch}", "same")
    assert folder.load("r1") == {"new": 3} and folder.matches_a_fresh_load()
    assert folder.load("r2") == {"unchanged": 3} and folder.read == []
    folder.write(2, "b", "c", "d", when=2_000_000_000)
    folder.write(3, "a3", "same", when=2_000_000_000)  # the same lines at another time
    folder.write(4, "neu")
    assert folder.load("r3") == {"new": 1, "changed": 1, "touched": 1, "unchanged": 1}
    assert folder.read == [["Colaboradores - 2.csv", "Colaboradores - 4.csv"]] and folder.matches_a_fresh_load()
    (folder.path / "Colaboradores - 1.csv").unlink()
    folder.write(4, when=2_100_000_000)  # nothing but a heading: left out, and so are its earlier rows
    assert folder.load("r4") == {"gone": 1, "changed": 1, "unchanged": 2} and folder.matches_a_fresh_load()
    before = rows(folder.ledger.table())
    folder.ledger.compact("r5")
    assert rows(folder.ledger.table()) == before and folder.load("r6") == {"unchanged": 3}
    time.sleep(0.1)
    assert len(folder.ledger.expire(1, 0.05)) == 3 and rows(folder.ledger.table()) == before


def test_gone_reports_may_stay(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    folder.write(1, "a")
    folder.write(2, "b")
    folder.load("r1")
    (folder.path / "Colaboradores - 1.csv").unlink()
    assert folder.load("r2", keep_missing=True) == {"unchanged": 1}
    assert rows(folder.ledger.table(), "Nome") == [("a",), ("b",)]


def test_two_loads_with_one_base(spark, tmp_path):
    folder = Folder(spark, tmp_path)
    folder.write(1, "a")

    def scan(s, places):
        assert folder.load("other") == {"new": 1}
        return hr_files.scan_hr_folder(s, places, with_file=True).staff

    with pytest.raises(LostRace):
        folder.ledger.load(str(folder.path), hr_files.CSV, "mine", scan)
    assert folder.matches_a_fresh_load()
    assert len([n for n in os.listdir(folder.ledger.folder) if n.startswith("load=")]) == 1


def test_workspace_loads_changed_files_only(spark, chain):  # noqa: F811
    shop, hr = Workspace(spark, str(chain / "shop")), chain / "inbox" / "hr"
    assert shop.load_changed_hr(str(hr), "1").new == 2
    assert shop.load_changed_hr(str(hr), "2").unchanged == 2
    whole = rows(shop.table("users_sci"))
    shop.load_hr(str(hr), "3")
    assert rows(shop.table("users_sci")) == whole


# ---- maintained sums -----------------------------------------------------------------


def test_sums_follow_any_series_of_reports(spark, tmp_path, frame):
    rng, sums, live = random.Random(3), MaintainedSums(spark, str(tmp_path / "sums")), {}
    kind = "report string, branch_key string, code_key string, amount double"
    for step in range(8):
        if step in (3, 6):
            gone = rng.sample(sorted(live), 2)
            sums.withdraw(frame("report string", *[(g,) for g in [*gone, "never issued"]]))
            for g in gone:
                del live[g]
        else:
            issued = {f"r{rng.randrange(6)}" for _ in range(3)}
            for report in issued:
                live[report] = [(report, rng.choice("12"), rng.choice("abc"), rng.choice([None, 0.0, -1.05, 2.35, 10.1])) for _ in range(rng.randrange(1, 9))]
            sums.issue(frame(kind, *[row for report in issued for row in live[report]]))
        wanted = {}
        for _, branch, code, amount in (row for report in live.values() for row in report):
            cents, n = wanted.get((branch, code), (0, 0))
            wanted[branch, code] = cents + round((amount or 0) * 100), n + 1
        found = {(r.branch_key, r.code_key): (round(r.amount * 100), r.lines) for r in sums.totals().collect()}
        assert found == wanted and sums.version == step + 1
        assert {r.report for r in sums.reports().collect()} == set(live)
    with pytest.raises(LostRace):
        sums.issue(frame(kind, ("x", "1", "a", 1.0)), base=2)
    assert sums.version == 8


# ---- previews and tax ids ------------------------------------------------------------


def test_first_values_keep_few_rows_in_every_task(frame):
    df = frame("k int, a string, b double", *[(i % 50, None if i % 3 else f"v{i}", float(i)) for i in range(300)]).repartition(6)
    found = previews.first_values(df, ["k", "b"], 4)
    table = sorted(((r.k, r.b, r.a) for r in df.collect()))
    wanted = {
        "k": [str(k) for k, _, _ in table][:4],
        "a": [a for _, _, a in table if a][:4],
        "b": [str(b) for _, b, _ in table][:4],
    }
    assert {c: [r.value for r in sorted(found.where(F.col("column") == c).collect(), key=lambda r: r.position)] for c in wanted} == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Python" not in plan
    assert previews.first_values(df.where("false"), ["k"]).isEmpty()


def check(digits):
    total = sum(int(d) * w for d, w in zip(digits, range(len(digits) + 1, 1, -1)))
    return str(0 if total % 11 < 2 else 11 - total % 11)


def test_check_digits(frame):
    rng = random.Random(5)
    whole = []
    for _ in range(400):
        nine = f"{rng.randrange(10 ** rng.randrange(1, 10)):09d}"
        ten = nine + check(nine)
        whole.append(ten + check(ten))
    whole = [w for w in whole if len(set(w)) > 1]
    wrong = [w[:-1] + str((int(w[-1]) + 1) % 10) for w in whole]
    short = [w.lstrip("0") for w in whole]
    texts = [*whole, *wrong, *short, None, "", "abc", "111.111.111-11", "000.000.000-00", "0", f"x{whole[0]}1"]
    found = {r.cpf0: r for r in people.repaired_tax_ids(frame("cpf0 string, cpf string", *[(t, t) for t in texts])).collect()}
    assert all((found[w].cpf, found[w].cpf_state) == (w, "valid") for w in whole)
    assert all((found[w].cpf, found[w].cpf_state) == (w, "unrepairable") for w in wrong)
    for w, s in zip(whole, short):
        assert found[s].cpf == w and found[s].cpf_state == ("padded" if s != w else "valid")
    assert [found[t].cpf_state for t in (None, "", "abc", "111.111.111-11", "0")] == ["missing"] * 3 + ["unrepairable"] * 2
    hr = frame("Filial string, CPF string, Cargo string", ("1", short[0], "X"), ("1", wrong[0], "X"))
    pos = frame("`Código` string, CPF string, Nome string", ("9", whole[0], "N"))
    assert rows(people.match_people(hr, pos, people.CHECKED), "cpf") == [(whole[0],)]
    assert tax_ids.DIGITS == 11


# ---- contracts -----------------------------------------------------------------------


def table_of(frame, columns, *values):
    return frame(", ".join(f"`{c}` string" for c in columns), *values)


def sound_tables(frame):
    """Tables of a workspace that break no rule, as lists of rows."""
    return {
        "VENDAS_VENDEDOR": (["Filial", "Código", "Valor Vendas"], [("F01", "20.0", "1,00"), ("F02", "21", "")]),
        "VENDAS_VENDEDOR_HB": (["Código", "Valor Vendas"], [("20", "1,00"), ("21", None)]),
        "VENDAS_FILIAL": (["Filial", "Faturamento Total", "Custo Total"], [("01", "1,00", "2,00"), ("02", "", "3,00")]),
        "VENDAS_548": (["Filial", "40% VT"], [("1", "1,00")]),
        "COMISSOES": (["Filial", "Código", "Valor Comissão"], [("01", "20", "1,00"), ("1", "20", "1,00")]),
        "users_trier": (["Código", "CPF"], [("20", "111.111.111-11"), ("21", "")]),
        "users_sci": (["Filial", "CPF"], [("1", "11111111111")]),
        "filtered_user": (["Filial", "Código", "Nome"], [("1", "20", "Ana"), ("2", "20", "Ana"), ("2", "21", "Bia")]),
        "META_FILIAL": (["Filial", "CMV", "Number"], [("F01", "46,7%", "1,00"), ("2", "", "")]),
        "TRAINEES": (["ID", "Filial", "Código"], [("120", "1", "20"), ("321", "3", "21")]),
        "2_META": (["ID", "Filial", "Código"], [("321", "3", "21")]),
        "AFASTAMENTOS": (["Filial", "Colaborador"], [("01", " ana ")]),
        "META_GERENTE": (["Filial"], [("1",), ("2",)]),
        "calc": (["ID"], [("120",), ("220",)]),
    }


# A row that breaks one rule, or several of one table at once, and how often each is broken then.
PLANTED = {
    "VENDAS_VENDEDOR": [(("F01", "x", "1,00"), {"Código is a seller code": 1}), (("F01", "20", "1.0x"), {"Valor Vendas is an amount or blank": 1})],
    "VENDAS_VENDEDOR_HB": [(("20", "y"), {"Código is unique": 2, "Valor Vendas is an amount or blank": 1})],
    "VENDAS_FILIAL": [(("F1", "z", "z"), {"Filial is unique": 2, "Faturamento Total is an amount or blank": 1, "Custo Total is an amount or blank": 1}), (("LOJA", "", ""), {"Filial is a branch number": 1})],
    "VENDAS_548": [(("F1", "R$ 1"), {"Filial is unique": 2, "40% VT is an amount or blank": 1})],
    "COMISSOES": [(("?", "99", "-"), {"Filial is a branch number": 1, "Valor Comissão is an amount or blank": 1, "Código refers to filtered_user": 1})],
    "users_trier": [(("20.0", "1"), {"Código is unique": 2, "CPF is a tax id or blank": 1})],
    "users_sci": [((None, "12"), {"Filial is a branch number": 1, "CPF is a tax id or blank": 1})],
    "filtered_user": [(("F1", "20", "X"), {"Filial, Código is unique": 2}), (("A", "B", "X"), {"Filial is a branch number": 1, "Código is a seller code": 1})],
    "META_FILIAL": [(("1", "n/d", "n/d"), {"CMV is a percentage or blank": 1, "Number is an amount or blank": 1, "Filial is unique": 2}), (("9", "", ""), {"Filial refers to VENDAS_FILIAL": 1})],
    "TRAINEES": [(("920", "9", "20"), {"Filial, Código refers to filtered_user or 2_META": 1})],
    "2_META": [(("321", "1.5", "77"), {"Filial is a branch number": 1, "ID is unique": 2, "Código refers to filtered_user": 1})],
    "AFASTAMENTOS": [(("2", "caio"), {"Filial, Colaborador refers to filtered_user": 1})],
    "META_GERENTE": [(("F01",), {"Filial is unique": 2})],
    "calc": [((" 120 ",), {"ID is unique": 2})],
}


def broken(spark, frame, tables):
    given = {name: table_of(frame, columns, *values) for name, (columns, values) in tables.items()}
    found = contracts.check_contracts(given, contracts.WORKSPACE_RULES, spark).collect()
    assert len(found) == len(contracts.WORKSPACE_RULES) and all((r.rows > 0) == (r["keys"] > 0) == bool(r.shown) for r in found)
    return {r.rule: r.rows for r in found if r.rows}


def test_every_rule_counts_what_breaks_it(spark, frame):
    tables = sound_tables(frame)
    assert broken(spark, frame, tables) == {}
    wanted = {}
    for name, plants in PLANTED.items():
        for row, rules in plants:
            tables[name][1].append(row)
            for rule, n in rules.items():
                wanted[f"{name}: {rule}"] = wanted.get(f"{name}: {rule}", 0) + n
    # Broken rows are parents and children elsewhere as well.
    wanted["META_FILIAL: Filial is unique"] = 2
    assert broken(spark, frame, tables) == wanted and len(wanted) == len(contracts.WORKSPACE_RULES)


def test_contracts_show_the_first_keys_and_skip_absent_tables(spark, frame):
    codes = table_of(frame, ["Código", "Valor Vendas"], *[(f"c{i % 40:02d}", "") for i in range(400)])
    found = contracts.check_contracts({"VENDAS_VENDEDOR_HB": codes}, contracts.WORKSPACE_RULES, spark)
    rows_of = {r.rule: (r.rows, r["keys"], r.shown) for r in found.collect()}
    assert rows_of == {
        "VENDAS_VENDEDOR_HB: Código is unique": (400, 40, ["c00", "c01", "c02", "c03", "c04"]),
        "VENDAS_VENDEDOR_HB: Valor Vendas is an amount or blank": (0, 0, []),
    }
    assert contracts.check_contracts({}, contracts.WORKSPACE_RULES, spark).collect() == []


def test_workspace_check(spark, chain, monkeypatch, capsys):  # noqa: F811
    from balcao import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda *a, **k: spark)
    inbox, root = chain / "inbox", ["--root", str(chain / "shop"), "--run", "1"]
    for kind, folder in (("sellers", "sellers"), ("commissions", "commissions"), ("branch_totals", "branches"), ("pos_staff", "staff")):
        assert cli.main([*root, "load-report", kind, str(inbox / folder)]) == 0
    assert cli.main([*root, "load-hr", str(inbox / "hr"), "--changed-only"]) == 0
    assert cli.main([*root, "match-people", "--repair-tax-ids"]) == 0
    assert cli.main([*root, "check"]) == 0
    write_csv(chain / "shop" / "manual" / "TRAINEES.csv", [["ID", "Filial", "Código", "Colaborador"], ["999", "9", "99", "X"]], ",")
    capsys.readouterr()
    assert cli.main([*root, "check"]) == 1
    assert "TRAINEES: Filial, Código refers to filtered_user or 2_META: 1 rows, 1 keys, such as 9|99" in capsys.readouterr().out
    assert cli.main([*root, "close", "--quarantine"]) == 0 and cli.main([*root, "expire", "--keep", "1", "--keep-days", "0"]) == 0


# ---- lineage -------------------------------------------------------------------------


def test_outcomes_add_up_for_every_report(spark, frame):
    rng = random.Random(8)
    for kind, judge in lineage.JUDGES.items():
        heads = {"sellers": 9, "hb_sellers": 9, "channel": 9, "commissions": 10, "branch_totals": 0, "pos_staff": 8}
        head = {
            "commissions": ["Código", "Vendedor", "Base Comissão", "% Comissão", "Valor Comissão"],
            "branch_totals": ["Código", "Descrição", "Total Vlr. Venda", "Total Vlr. Custo", "Vlr. Descto", "Ticket Médio Venda/Devol."],
            "channel": ["", "", "Código", "", "Vendedor", "Valor Vendas"],
            "pos_staff": ["", "Código", "Funcionário", "", "Demissão", "CPF"],
        }.get(kind, ["Código", "", "", "", "Vendedor", "Qtd. Vendas", "Valor Custo", "Valor Vendas"])
        texts = ["", "Filial:", "filial: ", "20", "8000", "Total Filial 1", "x", "123456789", "7"]
        lines, n = [], 0
        for file in ("a", "b"):
            for i in range(heads[kind]):
                lines.append((file, i, ["t"]))
            lines.append((file, heads[kind], head))
            for i in range(60):
                lines.append((file, heads[kind] + 1 + i, [rng.choice(texts) for _ in head]))
                n += 1
        cells = frame("file string, row_idx bigint, cells array<string>", *lines)
        judged = lineage.judged_rows(kind, cells, chunk_rows=7)
        assert judged.select("file", "row_idx").distinct().count() == judged.count() == n
        kept = judged.where("reason is null").count()
        reports_of = {
            "sellers": reports.seller_report, "hb_sellers": lambda r: reports.seller_rows(r, 9), "channel": reports.channel_report,
            "commissions": reports.commission_rows, "branch_totals": reports.branch_totals, "pos_staff": reports.pos_staff,
        }
        assert kept == reports_of[kind](cells).count() and judge
        found = {r.outcome: r.rows for r in lineage.drop_report(judged, kind).groupBy("outcome").agg(F.sum("rows").alias("rows")).collect()}
        assert sum(found.values()) == n and found["kept"] == kept and len(found) >= 2


def test_people_left_out(frame):
    hr = frame("Filial string, CPF string, Cargo string", ("1", "11", "x"), ("1", "", "x"), (None, "22", "x"), ("2", "33", "x"), ("3", "44", "x"))
    pos = frame("`Código` string, CPF string, Nome string", ("5", "11", "n"), ("6", "11", "n"), ("7", "22", "n"), ("8", None, "n"), (None, "44", "n"), ("9", "55", "n"))
    judged = lineage.judged_people(hr, pos)
    assert rows(judged) == sorted([
        ("hr", "11", None), ("hr", "", "no tax id"), ("hr", "22", "no branch or code"), ("hr", "33", "tax id is not on the other side"),
        ("hr", "44", "no branch or code"), ("pos", "11", None), ("pos", "11", None), ("pos", "22", "no branch or code"),
        ("pos", None, "no tax id"), ("pos", "44", "no branch or code"), ("pos", "55", "tax id is not on the other side"),
    ], key=repr)
    assert people.match_people(hr, pos).count() == 2


# ---- sketches ------------------------------------------------------------------------


def test_sketches_are_within_their_error(spark, tmp_path, frame):
    sizes = {"a": (0, 60_000), "b": (45_000, 90_000)}
    kept = {}
    for name, (first, last) in sizes.items():
        folder = str(tmp_path / name)
        df = spark.range(first, last).select(F.col("id").cast("string").alias("cpf"), F.lit("").alias("blank"))
        snapshots.write_snapshot(df.unionByName(df.limit(50)), folder, "1")
        sketches.store_sketches(spark, folder, {"cpf": F.col("cpf"), "blank": F.col("blank")})
        kept[name] = sketches.stored_sketches(spark, folder)
        (row,) = sketches.estimates(kept[name]).collect()
        assert (row.key, row.rows, row.exact) == ("cpf", last - first + 50, last - first)
        assert abs(row.estimated - row.exact) <= 3 * sketches.standard_error() * row.exact
    (row,) = sketches.overlap(kept["a"], "cpf", kept["b"], "cpf").collect()
    assert abs(row.both - 15_000) <= 3 * sketches.standard_error() * (90_000 / 15_000) ** 0.5 * 15_000
    assert abs(row.either - 90_000) <= 3 * sketches.standard_error() * 90_000
    plan = sketches.overlap(kept["a"], "cpf", kept["b"], "cpf")._jdf.queryExecution().executedPlan().toString()
    assert "snapshot=" not in plan
    with pytest.raises(snapshots.NoSnapshot):
        sketches.store_sketches(spark, str(tmp_path / "none"), {})


# ---- dated rules ---------------------------------------------------------------------


def paid_by(steps, kind, value, day):
    found = [(at, amount) for k, first, last, at, amount in steps if k == kind and first <= day and (last is None or day <= last) and value is not None and at <= value]
    return max(found)[1] if found else None


def test_rules_of_the_day(spark, frame):
    rng, day = random.Random(2), dt.date(2024, 1, 1)
    steps = []
    for kind in "ab":
        for at in (float("-inf"), 0.5, 1.0, 2.0):
            first = day
            for _ in range(rng.randrange(1, 4)):
                last = first + dt.timedelta(rng.randrange(20))
                steps.append((kind, first, last, at, float(rng.randrange(100))))
                first = last + dt.timedelta(rng.randrange(1, 5))
            if rng.random() < 0.5:
                steps.append((kind, first, None, at, -1.0))
    rules = dated_rules.checked(frame(dated_rules.SCHEMA, *steps))
    facts = [(i, day + dt.timedelta(rng.randrange(-5, 90)), rng.choice([None, -1.0, 0.5, 0.7, 1.0, 3.0]), rng.choice([0.4, 2.0])) for i in range(300)]
    df = frame("i int, day date, x double, y double", *facts)
    found = dated_rules.add_amounts(df, rules, [("a", "x", "pa"), ("b", F.col("y"), "pb")], "day")
    assert found.columns == ["i", "day", "x", "y", "pa", "pb"]
    assert rows(found, "i", "pa", "pb") == sorted([(i, paid_by(steps, "a", x, d), paid_by(steps, "b", y, d)) for i, d, x, y in facts], key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = dated_rules.add_amounts(df, rules.where("false"), [("a", "x", "pa")], "day")
    assert none.where("pa is not null").isEmpty()


def test_contradicting_rules(frame):
    day = dt.date(2024, 1, 1)
    with pytest.raises(dated_rules.OverlappingRules, match="a from 1.0"):
        dated_rules.checked(frame(dated_rules.SCHEMA, ("a", day, None, 1.0, 1.0), ("a", day + dt.timedelta(3), None, 1.0, 2.0)))


def test_a_change_of_rules_within_the_year(spark, frame):
    tables = month(frame, spark)
    tables = replace(tables, second_targets=None, branch_targets=tables.branch_targets.where("CMV <> 'junk'"), people=tables.people.where("Filial in ('1', '2')"),
                     previous=frame("ID string, Meta string, row_idx bigint", ("222", "8,00", 0)))
    today = dated_rules.todays_rules(spark)
    change = dt.date(2024, 7, 1)
    rules = today.withColumn("valid_to", F.date_sub(F.lit(change), 1)).unionByName(
        today.withColumns({"valid_from": F.lit(change), "amount": F.col("amount") * 2})
    )
    plain = rows(close_month(tables, spark).calc, "id", "paid", "bonus", "total")
    assert ("222", 1.0, 150.0, 151.0) in plain
    assert rows(close_month(tables, spark, rules=rules, as_of=dt.date(2024, 6, 30)).calc, "id", "paid", "bonus", "total") == plain
    assert ("222", 2.0, 300.0, 302.0) in rows(close_month(tables, spark, rules=rules, as_of=change).calc, "id", "paid", "bonus", "total")
    with pytest.raises(ValueError, match="day"):
        close_month(tables, spark, rules=rules)


def test_reports_are_judged_side_by_side(spark, monkeypatch):
    """All five are under way at the same time; one after the other the barrier would break."""
    from balcao.catalogue import upkeep

    meet, judged = threading.Barrier(5, timeout=60), lineage.judged_rows

    def waits(kind, report):
        meet.wait()
        return judged(kind, report)

    monkeypatch.setattr(lineage, "judged_rows", waits)
    assert upkeep.dropped_rows(spark, "/root/testdata/sf0.001").select("step").distinct().count() == 5
