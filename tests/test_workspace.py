"""The whole pipeline from report files to payouts, on a small made-up chain."""

import csv

import pytest

from balcao.__main__ import parse
from balcao.plans.workspace import UnreadableReport, Workspace
from balcao.sources.snapshots import EmptyOutput
from tests.conftest import rows


def write_csv(path, lines, delimiter=";"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, delimiter=delimiter).writerows(lines)


def sellers(*body):
    head = ["Código", "", "", "", "Vendedor", "Qtd. Vendas", "Valor Custo", "Valor Vendas"]
    return [["Relatório", "", "", "", "", "", "", ""]] * 9 + [head, *body]


@pytest.fixture
def chain(tmp_path):
    inbox = tmp_path / "inbox"
    write_csv(
        inbox / "sellers" / "vendas.csv",
        sellers(
            ["Filial:", "", "", "1"],
            ["20", "", "", "", "ANA", "1", "0", "1.000,00"],
            ["21", "", "", "", "BIA", "1", "0", "500,00"],
            ["Filial:", "", "", "2"],
            ["20", "", "", "", "ANA", "1", "0", "50,00"],
            ["22", "", "", "", "CAIO", "1", "0", "10,00"],
        ),
    )
    channel = ["", "", "Código", "", " Vendedor", "Qtd. Vendas", "", "Valor Custo", "Margem Lucro", "Valor Vendas"]
    blank = [""] * 10
    write_csv(
        inbox / "channel" / "c.csv",
        [blank] * 9 + [channel, ["", "", "", "1", *[""] * 6], [*[""] * 9, "100.00"]],
    )
    write_csv(
        inbox / "commissions" / "c.csv",
        [["x", "", "", "", ""]] * 10
        + [
            ["Código", "Vendedor", "Base Comissão", "% Comissão", "Valor Comissão"],
            ["Filial:", "1", "", "", ""],
            ["20", "ANA", "1000", "1", "100,01"],
            ["21", "BIA", "1000", "1", "40,00"],
            ["Filial:", "2", "", "", ""],
            ["20", "ANA", "1000", "1", "5,00"],
        ],
    )
    write_csv(
        inbox / "branches" / "b.csv",
        [
            ["Código", "Descrição", "Total Vlr. Venda", "Total Vlr. Custo", "Vlr. Descto", "Ticket Médio Venda/Devol."],
            ["Filial:", "1 CENTRO", "", "", "", ""],
            ["8000", "HB", "10,00", "", "", ""],
            ["Total Filial 1", "", "", "700,00", "1.500,00", "30,00"],
        ],
    )
    write_csv(
        inbox / "staff" / "s.csv",
        [[""] * 10] * 8
        + [
            ["", "Código", "Funcionário", "", "", "Admissão", "Operad.Cx.", "Vendedor", "Status", "Demissão"],
            ["", "20", "Ana", *[""] * 7],
            [*[""] * 9, "111.111.111-11"],
            ["", "21", "Bia", *[""] * 7],
            [*[""] * 9, "222.222.222-22"],
            ["", "22", "Caio", *[""] * 7],
            [*[""] * 9, "333.333.333-33"],
        ],
    )
    hr = "CPF;Nome;Cargo atual;Cidade;Sexo;Deficiência;País de nascimento;Data de nascimento;Idade;Data de admissão;Data de desligamento;Salário atual".split(";")
    rest = ["X"] * 9
    write_csv(
        inbox / "hr" / "COLABORADORES - 01.csv",
        [hr, ["11111111111", "Ana", "1 - FARMACEUTICO", *rest], ["22222222222", "Bia", "GERENTE", *rest]],
    )
    write_csv(
        inbox / "hr" / "COLABORADORES - 02.csv", [hr, ["33333333333", "Caio", "FARMACEUTICO", *rest]]
    )
    manual = tmp_path / "shop" / "manual"
    write_csv(manual / "META_FILIAL.csv", [["Filial", "Number", "HB", "TKT MÉDIO", "CMV"], ["F01", "1.450,00", "10,00", "25,00", "46,7%"]], ",")
    write_csv(manual / "AFASTAMENTOS.csv", [["Filial", "Colaborador"], ["2", "caio"]], ",")
    write_csv(manual / "targets.csv", [["ID", "Meta"], ["120", "1.000,00"], ["121", "1,00"]], ",")
    return tmp_path


def test_reports_to_payouts(spark, chain):
    shop = Workspace(spark, str(chain / "shop"))
    inbox = chain / "inbox"
    assert shop.load_report("sellers", str(inbox / "sellers"), "r1")
    assert shop.load_report("channel", str(inbox / "channel"), "r1")
    assert shop.load_report("commissions", str(inbox / "commissions"), "r1")
    assert shop.load_report("branch_totals", str(inbox / "branches"), "r1")
    assert shop.load_report("pos_staff", str(inbox / "staff"), "r1")
    assert shop.load_hr(str(inbox / "hr"), "r1").isEmpty()
    assert shop.match_people("r1")
    matched = sorted(shop.table("filtered_user", with_order=True).collect(), key=lambda r: r.row_idx)
    assert [(r["Filial"], r["Código"]) for r in matched] == [("1", "20"), ("1", "21"), ("2", "22")]
    assert shop.close("r1")
    # Ana: 1,050.00 sold everywhere plus 40.00 of the branch's channel share.
    assert rows(shop.table("calc")) == [
        ("120", "1", "20", "ANA", "1.000,00", "1.050,00", "1.090,00", "109,00%", "FARMACEUTICO", "105,01", "105,01", "75,00", "180,01"),
        ("121", "1", "21", "BIA", "1,00", "500,00", "500,00", "50000,00%", "GERENTE", "", "", "", "964,00"),
    ]
    assert rows(shop.table("META_GERENTE")) == [("1", "250,00", "200,00", "200,00", "300,00", "14,00")]
    # A second run finds the targets in the first run's output, without the manual list.
    (chain / "shop" / "manual" / "targets.csv").unlink()
    spark.catalog.clearCache()
    assert shop.close("r2")
    assert rows(shop.table("calc"), "ID", "Meta") == [("120", "1.000,00"), ("121", "1,00")]


def test_missing_and_empty_inputs(spark, tmp_path):
    shop = Workspace(spark, str(tmp_path / "shop"))
    with pytest.raises(FileNotFoundError, match="users_sci"):
        shop.match_people("r1")
    with pytest.raises(FileNotFoundError, match="filtered_user"):
        shop.close("r1")
    write_csv(tmp_path / "in" / "a.csv", sellers())
    assert not shop.load_report("sellers", str(tmp_path / "in"), "r1")
    assert shop.table("VENDAS_VENDEDOR").isEmpty()
    write_csv(tmp_path / "hr" / "other.csv", [["CPF"], ["1"]])
    with pytest.raises(EmptyOutput):
        shop.load_hr(str(tmp_path / "hr"), "r1")


def test_command_line():
    options = parse(["--root", "/x", "load-report", "sellers", "/in"])
    assert (options.step, options.kind, options.folder) == ("load-report", "sellers", "/in")
    assert parse(["--root", "/x", "--run", "r", "match-people", "--pad-tax-ids"]).pad_tax_ids


def test_several_rows_for_one_key_in_written_tables(spark, chain):
    """The first row of a branch counts, and the last filled target of an id."""
    shop = Workspace(spark, str(chain / "shop"))
    manual = chain / "shop" / "manual"
    write_csv(manual / "targets.csv", [["ID", "Meta"], ["120", "9,00"], ["120", "1.000,00"], ["120", ""]], ",")
    write_csv(
        manual / "META_FILIAL.csv",
        [["Filial", "Number", "HB", "TKT MÉDIO", "CMV"], ["F01", "1.450,00", "10,00", "25,00", "46,7%"], ["F01", "1,00", "1,00", "1,00", "1%"]],
        ",",
    )
    for kind, folder in (("sellers", "sellers"), ("commissions", "commissions"), ("branch_totals", "branches"), ("pos_staff", "staff")):
        assert shop.load_report(kind, str(chain / "inbox" / folder), "1")
    shop.load_hr(str(chain / "inbox" / "hr"), "1")
    assert shop.match_people("1") and shop.close("1")
    assert ("120", "1.000,00") in rows(shop.table("calc"), "ID", "Meta")
    assert rows(shop.table("META_GERENTE")) == [("1", "250,00", "200,00", "200,00", "300,00", "14,00")]


def test_unreadable_reports_and_exit_codes(spark, tmp_path, monkeypatch):
    from balcao import __main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda *a, **k: spark)
    root = ["--root", str(tmp_path / "shop"), "--run", "1"]
    write_csv(tmp_path / "in" / "a.csv", sellers())
    assert cli.main([*root, "load-report", "sellers", str(tmp_path / "in")]) == 1
    write_csv(tmp_path / "full" / "a.csv", sellers(["Filial:", "", "", "1"], ["20", "", "", "", 'LOJA 32" TV', "1", "0", "7,00"]))
    (tmp_path / "full" / "a.csv").write_text((tmp_path / "full" / "a.csv").read_text().replace('"LOJA 32"" TV"', 'LOJA 32" TV'))
    root[-1] = "2"
    assert cli.main([*root, "load-report", "sellers", str(tmp_path / "full"), "--delimiter", ";"]) == 0
    assert rows(Workspace(spark, str(tmp_path / "shop")).table("VENDAS_VENDEDOR"), "Vendedor", "Valor Vendas") == [('LOJA 32" TV', "7,00")]
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "a.csv").write_text('x;"never closed\n1;2\n')
    with pytest.raises(UnreadableReport, match="unpaired quotes"):
        cli.main([*root, "load-report", "sellers", str(tmp_path / "open")])
