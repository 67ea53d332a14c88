import pytest

from balcao.operators import people, source_filters
from balcao.sources import columns
from tests.conftest import rows

HR = "`Nº CPF` string, `Filial (loja)` string, Cargo string, Nome string"
POS = "`CPF ` string, `Codigo` string, `Nome do funcionário` string"


@pytest.fixture
def sides(frame):
    hr = frame(
        HR,
        ("012.345.678-90", "1", "01 - GERENTE", "x"),
        ("111", "2", "FARMACEUTICO", "x"),
        ("111", "3", "CAIXA", "x"),
        ("", "4", "none", "x"),
        ("222", "5", "only here", "x"),
        ("333", None, "no branch", "x"),
    )
    pos = frame(
        POS,
        ("01234567890", "20", "Ana"),
        ("111", "21", "Bia"),
        ("1-1-1", "22", "Bia 2"),
        (" ", "23", "none"),
        ("333", "24", "Caio"),
        ("1234567890", "25", "short"),
    )
    return hr, pos


def test_match(sides):
    found = people.match_people(*sides)
    assert rows(found) == [
        ("1", "20", "01234567890", "Ana", "01 - GERENTE"),
        ("2", "21", "111", "Bia", "FARMACEUTICO"),
        ("2", "22", "111", "Bia 2", "FARMACEUTICO"),
        ("3", "21", "111", "Bia", "CAIXA"),
        ("3", "22", "111", "Bia 2", "CAIXA"),
    ]
    padded = people.match_people(*sides, pad=True)
    assert ("1", "25") in rows(padded, "branch", "code")
    assert [r.code for r in found.orderBy(*people.people_order()).collect()][0] == "20"


def test_stats(sides):
    assert tuple(people.match_stats(*sides).first()) == (4, 4, 3)


def test_no_overlap_gives_no_people(frame):
    hr = frame(HR, ("1", "1", "G", "x"))
    pos = frame(POS, ("2", "1", "A"))
    assert people.match_people(hr, pos).isEmpty()
    assert tuple(people.match_stats(hr, pos).first()) == (1, 1, 0)


def test_profile(frame):
    df = frame("branch int, code int, name string", (2, 1, "b"), (1, 5, None), (1, 7, "b"))
    assert rows(people.profile(df, ["branch", "code"])) == [
        ("branch", 3, 2, "1"),
        ("code", 3, 3, "5"),
        ("name", 2, 1, None),
    ]


def test_missing_columns_are_named(frame):
    with pytest.raises(ValueError, match="title"):
        people.hr_side(frame("cpf string, filial string", ("1", "2")))


def test_column_search_prefers_terms_then_position(frame):
    df = frame("Cargo string, `Cargo Atual` string, `CARGO ATUAL 2` string", ("a", "b", "c"))
    assert columns.find_column(df, ["cargo atual", "cargo"]) == "Cargo Atual"
    assert columns.find_column(df, ["nome"]) is None
    assert columns.in_order(df, ["x", "Cargo"]).first().asDict() == {"x": None, "Cargo": "a"}


def test_source_filters(frame):
    staff = frame("i int, `Data de desligamento` string", (1, None), (2, ""), (3, " "), (4, "nan"), (5, "01/02/2024"))
    assert rows(source_filters.active_staff(staff), "i") == [(1,), (2,), (3,), (4,)]
    products = frame("i int, `group` string, department string", (1, "8000", "20"), (2, "8000", "21"), (3, "1", "21"), (4, "8000", None))
    assert rows(source_filters.hb_products(products), "i") == [(2,), (4,)]
    sales = frame("code string, amount int", ("548", 1), ("548.0", 2), ("54", 3), (None, 4))
    assert rows(source_filters.channel_sales(sales), "amount") == [(1,), (2,)]
