import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from balcao.functions import text as t
from balcao.functions.money import round2, sum_money

MANY = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_brazilian_numbers_are_read(values):
    cases = {
        "12.345,67": 12345.67,
        "1234.5": 12345.0,
        "-1.234,56": -1234.56,
        " 7,5 ": 7.5,
        " 7,5\t": 7.5,
        "": None,
        "   ": None,
        None: None,
        "(1,00)": None,
        "R$ 1,00": None,
        "nan": None,
        "inf": None,
        "-Infinity": None,
        "1e3": 1000.0,
        "1d": None,
        "1,2,3": None,
        "1e999": None,
    }
    assert values(t.br_to_double, list(cases)) == list(cases.values())


def test_brazilian_text_is_written(values):
    numbers = [1234567.125, -1234.5, -0.001, 0.0, None, float("nan"), 2.675, 1e10]
    assert values(t.br_text, numbers, "double")[:5] == [
        "1.234.567,12",
        "-1.234,50",
        "0,00",
        "0,00",
        None,
    ]
    assert values(t.br_text, [2.675, 1e10], "double") == ["2,67", "10.000.000.000,00"]
    assert values(t.br_text_unsigned, [-1234.5], "double") == ["1.234,50"]
    assert values(t.br_text_in_parentheses, [-3.0, 3.0], "double") == ["(3,00)", "3,00"]
    assert values(t.br_text_keep_zero_sign, [-0.001, -1.5], "double") == ["-0,00", "-1,50"]


def test_rounding_ties_go_to_even_on_the_binary_value(values):
    cases = {0.125: 0.12, 2.675: 2.67, 1.005: 1.0, 5.005: 5.0, 0.375: 0.38, -0.125: -0.12}
    assert values(round2, list(cases), "double") == list(cases.values())


@MANY
@given(st.lists(st.integers(-(10**11), 10**11), min_size=200, max_size=400))
def test_rounding_is_python_rounding(values, cents):
    products = [c / 100 * f for c in cents for f in (0.5, 0.1, 0.05)]
    assert values(round2, products, "double") == [round(p, 2) for p in products]


@MANY
@given(st.lists(st.integers(-(10**13), 10**13), min_size=100, max_size=300))
def test_written_numbers_read_back(values, cents):
    numbers = [c / 100 for c in cents]
    assert values(lambda c: t.br_to_double(t.br_text(c)), numbers, "double") == numbers


@MANY
@given(st.lists(st.integers(-(10**10), 10**10), min_size=1, max_size=500), st.integers(1, 16))
def test_money_sums_are_exact_in_any_partitioning(spark, cents, parts):
    df = spark.createDataFrame([(c / 100,) for c in cents], "v double").repartition(parts)
    assert df.agg(sum_money(F.col("v"))).first()[0] == sum(cents) / 100


def test_money_sums_keep_fractions_of_a_cent(frame):
    df = frame("v double", (10.005,), (10.005,), (None,))
    assert df.agg(sum_money(F.col("v"))).first()[0] == pytest.approx(20.01, abs=1e-9)
    assert frame("v double", (None,)).agg(sum_money(F.col("v"))).first()[0] is None


def test_percentages(values):
    assert values(t.percent_text, [1234.5, -5.25, -0.5, -5.05, 99.999, None], "double") == [
        "1234,50%",
        "-5,-25%",
        "0,-50%",
        "-5,-5%",
        "100,00%",
        None,
    ]
    assert values(t.percent_to_double, ["12,5%", " 7 % ", "", None, "nan"]) == [
        12.5,
        7.0,
        None,
        None,
        None,
    ]
    with pytest.raises(Exception, match="not a percentage"):
        values(t.percent_to_double, ["abc"])


def test_branch_keys(values):
    texts = ["F01", "01", "1", "1.0", "f7 ", "MATRIZ", "", None, "FF3", "nan"]
    assert values(t.branch_key, texts) == ["1", "1", "1", "1", "7", "MATRIZ", "", "", "F3", "NAN"]
    zeros = values(lambda c: t.branch_key(c, keep_zeros=True), ["F01", "1.0", " f07", None])
    assert zeros == ["01", "1.0", "07", ""]
    assert values(t.branch_without_f, ["F01", "f1F ", "A"]) == ["01", "1", "A"]
    assert values(t.branch_number, ["F01", "12"]) == [1, 12]
    with pytest.raises(Exception, match="not a branch number"):
        values(t.branch_number, ["MATRIZ"])


def test_codes_and_ids(values):
    assert values(t.code_key, ["20.0", "100", "10.05", " 7 "]) == ["20", "100", "105", "7"]
    assert values(t.code_number, ["20.0", "7"]) == [20, 7]
    with pytest.raises(Exception, match="not a seller code"):
        values(t.code_number, ["7x"])
    assert values(t.zero_pad2, ["1", "12", "123", "", None]) == ["01", "12", "123", "00", None]
    assert values(t.tax_id, ["012.345.678-90", "abc"]) == ["01234567890", ""]
    assert values(lambda c: t.tax_id(c, pad=True), ["1234567890", ""]) == ["01234567890", ""]


def test_same_id_for_different_people(frame):
    df = frame("branch bigint, code bigint", (1, 23), (12, 3))
    assert [r[0] for r in df.select(t.person_id(df.branch, df.code)).collect()] == ["123", "123"]


def test_roles_and_names(values):
    titles = ["12 - GERENTE", "12 - A - B", "gerente", "-x", None, "A-\nb"]
    assert values(t.role_of, titles) == ["GERENTE", "A - B", "GERENTE", "X", None, "B"]
    assert values(t.upper_name, [" josé "]) == ["JOSÉ"]
    assert values(t.first_word, [" 12 LOJA", "12", ""]) == ["12", "12", ""]
    assert values(t.clean_email, [" a@b ", "nan", None, ""]) == ["a@b", "", "", ""]


def test_numbers_that_do_not_parse_are_missing(values):
    texts = ["12", " 1.5 ", "1,5", "x", "nan", ""]
    assert values(t.to_number, texts) == [12.0, 1.5, None, None, None, None]
    assert values(t.is_digits, ["12", "1.0", "", None]) == [True, False, False, False]


def test_quantities(values):
    texts = ["1234", "1234.0", "1234.5", "-1234.5", "abc", "12345678.25", None]
    assert values(t.quantity_text, texts) == [
        "1.234",
        "1.234",
        "1.234.5",
        "-1.234.5",
        "abc",
        "12.345.678.25",
        None,
    ]


def test_export_text(values):
    assert values(t.export_text, ['a\n\r\tb "c"', "nan", "None", None, ""]) == [
        "a b 'c'",
        "",
        "",
        "",
        "",
    ]


def test_channel_share(values):
    assert values(t.channel_share, [10.03, None], "double") == [4.01, None]
    assert not math.isnan(values(t.channel_share, [0.0], "double")[0])


def test_amounts_are_formatted_once(values):
    assert str(t.br_text(F.col("v"))).count("format_number") == 1
    shown = values(t.br_text, [-0.001, -0.0, -10.0, -1000.004, 0.0, None], "double")
    assert shown == ["0,00", "0,00", "-10,00", "-1.000,00", "0,00", None]
