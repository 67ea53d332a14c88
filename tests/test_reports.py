"""Report grids flattened, checked against plain loops over the same grids."""

import random

import pytest
from pyspark.sql import functions as F

from balcao.operators import reports
from tests.conftest import rows

CELLS = "file string, row_idx bigint, cells array<string>"
SELLER_HEAD = ["Código", "", "", "", " Vendedor ", "Qtd. Vendas", "Valor Custo", "Valor Vendas"]


@pytest.fixture
def grid(spark):
    def build(**files):
        data = [(f, i, c) for f, lines in files.items() for i, c in enumerate(lines)]
        return spark.createDataFrame(data, CELLS).repartition(3)

    return build


def seller(code, name, amount):
    return [code, "", "", "", name, "1", "0", amount]


def section(branch, label="Filial: "):
    return [label, "", "", branch]


def test_seller_report(grid):
    title = [["Relatório"]] * 9
    report = grid(
        a=[
            *title,
            SELLER_HEAD,
            seller("5", "EVA", "1,00"),
            section("1"),
            seller(" 20 ", "ANA", "1.234,56"),
            ["", "", ""],
            seller("7.0", "no digits", "9,99"),
            section("", "FILIAL:"),
            seller("21", "BIA", "2,00"),
            section("3"),
            section("4"),
            seller("22", "CAIO", "3,00"),
            ["Total", "", "", "", "", "", "", "9"],
        ],
        b=[*title, SELLER_HEAD, section("9"), seller("1", "DUDA", "4,00")],
    )
    assert rows(reports.seller_report(report, chunk_rows=2)) == sorted(
        [
            (None, "5", "EVA", "1,00"),
            ("1", "20", "ANA", "1.234,56"),
            (None, "21", "BIA", "2,00"),
            ("4", "22", "CAIO", "3,00"),
            ("9", "1", "DUDA", "4,00"),
        ],
        key=repr,
    )


def test_hb_report_sums_codes_and_drops_some(grid):
    lines = [["x"]] * 9 + [
        SELLER_HEAD,
        section("1"),
        seller("20", "", "1.000,00"),
        seller("548", "APP", "5,00"),
        seller("300", "X", "5,00"),
        seller("3", "Y", "5,00"),
        section("2"),
        seller("20", "ANA", "234,56"),
        seller("20", "ANA 2", "bad"),
        seller("21", "BIA", "-0,001"),
    ]
    assert rows(reports.hb_seller_report(grid(a=lines), chunk_rows=3)) == [
        (20, "ANA", "1.234,56"),
        (21, "BIA", "-0,00"),
    ]


def test_duplicate_count(frame):
    df = frame("code bigint", (1,), (1,), (1,), (2,))
    assert reports.duplicate_count(df, "code").first()[0] == 2


def test_commission_report(grid):
    head = ["Código", "Vendedor", "Base Comissão", "% Comissão", "Valor Comissão"]
    lines = [["x"]] * 10 + [
        head,
        ["1", "NO BRANCH", "1", "1", "1"],
        ["Filial:", " 7 "],
        ["20", "ANA", "10,00", "1", "0,10"],
        ["20.0", "not digits", "1", "1", "1"],
        ["filial:", "8"],
        ["21", "BIA", "10,00", "1", "0,20"],
        ["Filial:", " "],
        ["22", "CAIO", "10,00", "1", "0,30"],
        ["Filial: ", "012"],
        ["23", "DUDA", "10,00", "1", "0,40"],
    ]
    assert rows(reports.commission_report(grid(a=lines), chunk_rows=2)) == [
        ("07", "20", "ANA", "10,00", "1", "0,10"),
        ("07", "21", "BIA", "10,00", "1", "0,20"),
        ("12", "23", "DUDA", "10,00", "1", "0,40"),
    ]


def test_commission_report_needs_its_columns(grid):
    lines = [["x"]] * 10 + [["Código", "Vendedor"], ["1", "A"]]
    with pytest.raises(Exception, match="missing columns base comissão"):
        reports.commission_report(grid(a=lines)).collect()


def test_channel_report_takes_sales_from_the_row_below(grid):
    head = ["", "", "Código", "", " Vendedor", "Qtd. Vendas", "", "Valor Custo", "Margem Lucro", "Valor Vendas"]

    def line(branch, sales):
        return ["", "", "x", branch, "", "", "", "", "", sales]

    lines = [["x"]] * 9 + [
        head,
        line("1", "77"),
        line("", "10.03"),
        line("2", ""),
        line("", "1.234,56"),
        line("3", ""),
    ]
    assert rows(reports.channel_report(grid(a=lines), chunk_rows=1)) == [
        ("1", 10.03, 4.01),
        ("2", None, None),
        ("3", None, None),
    ]


def test_pos_staff(grid):
    head = ["", " Código  usuário", "Nome do Funcionário", "", "", "Admissão", "Operad.Cx.", "Vendedor", "Status", "Demissão"]

    def person(code, name, left, cpf):
        return [
            ["", code, name, "", "", "1/1/2020", "", "", "", left],
            ["", "", "", "", "", "", "", "", "", cpf],
        ]

    lines = [["x"]] * 8 + [
        head,
        *person("20", "ANA", "5/5/2024", "012.345"),
        *person("123456789", "TEST", "", "1"),
        *person("Página 1 de", "", "", ""),
        *person("21.0", "BIA", "", ""),
    ]
    assert rows(reports.pos_staff(grid(a=lines), chunk_rows=3)) == [
        ("20", "ANA", "012.345"),
        ("21.0", "BIA", None),
    ]


TOTALS_HEAD = ["Código", "Descrição", "Total Vlr. Venda", "Total Vlr. Custo", "Vlr. Descto", "Ticket Médio Venda/Devol."]


def expected_totals(lines):
    branch = hb = None
    out = []
    for code, beside, sales, cost, revenue, ticket in lines:
        if code == "Filial:":
            branch = (beside or "None").split()[0]
        elif code == "8000":
            hb = sales
        elif code.startswith("Total Filial"):
            if branch is None:
                continue
            out.append((branch.zfill(2), hb, cost, revenue, ticket))
            branch = hb = None
    return out


@pytest.mark.parametrize("seed", range(4))
def test_branch_totals_match_a_loop(grid, seed):
    rng = random.Random(seed)
    files, expected = {}, []
    for f in range(6):
        body = []
        for i in range(60 if f else 300):
            kind = rng.choice(["Filial:", "8000", "Total Filial 1", "1000", "detail"])
            beside = rng.choice(["1 LOJA", "22", "", "7 X"]) if kind == "Filial:" else "d"
            body.append([kind, beside, f"s{i}", f"c{i}", f"r{i}", f"t{i}"])
        files[f"f{f}"] = [TOTALS_HEAD, *body]
        expected += expected_totals(body)
    found = reports.branch_totals(grid(**files), chunk_rows=9).drop("file", "row_idx")
    assert rows(found) == sorted(expected, key=repr)


def test_results_do_not_depend_on_partitions(grid):
    lines = [["x"]] * 9 + [SELLER_HEAD, section("1")] + [seller(str(i), "N", "1,00") for i in range(50)]
    report = grid(a=lines)
    assert rows(reports.seller_report(report.repartition(7))) == rows(
        reports.seller_report(report.coalesce(1).orderBy(F.desc("row_idx")), chunk_rows=4)
    )


def test_positions_are_worked_out_once_a_file(spark, grid):
    """Rows get positions, written once a file; no row looks at its file's names."""
    report = grid(a=[*[["t"]] * 9, SELLER_HEAD, section("1"), seller("5", "EVA", "1,00")])
    for lines in (reports.seller_lines(report, 9), reports.seller_report(report)):
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "array_position" not in plan and "lower(regexp" not in plan
    assert rows(reports.seller_report(report)) == [("1", "5", "EVA", "1,00")]


def test_details_are_printed_without_being_summed_again(frame):
    from balcao.catalogue import retail

    schema = "month string, branch bigint, code bigint, amount double"
    sold = frame(schema, ("1995-01", 1, 7, 10.25), ("1995-01", 1, 8, 0.5), ("1995-02", 8, 7, 1.005))
    printed = retail.seller_grid(sold)
    plan = printed._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate(" in line and "code#" in line]
    found = {r.file: [] for r in printed.collect()}
    for r in printed.orderBy("row_idx").collect():
        found[r.file].append([c for c in r.cells if c])
    body = [["FILIAL: ", "1"], [" 7", "V7", "1", "10,25"], [" 8", "V8", "1", "0,50"], ["Total", "10,75"]]
    assert found["1995-01"][2:] == body and found["1995-02"][2:] == [["FILIAL: "], [" 7", "V7", "1", "1,00"], ["Total", "1,00"]]
