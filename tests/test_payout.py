import pytest
from pyspark.sql import functions as F

from balcao.operators import payout, sales, scorecard
from balcao.sources import tabs
from tests.conftest import rows

PERSON = "id string, branch bigint, code bigint, name string, role string"


def person(number, role="FARMACEUTICO", branch=1):
    return (f"{branch}{number}", branch, number, f"P{number}", role)


def test_achieved_over_all_branches_or_own(spark, frame):
    people = frame(PERSON, person(5), person(7, branch=1), person(7, branch=2), person(9))
    sold = tabs.seller_sales(
        frame(
            "Filial string, `Código` string, Vendedor string, `Valor Vendas` string",
            ("F1", "5.0", "", "1,10"),
            ("f2", "5", "", "2,20"),
            ("1", "7", "", "10,00"),
            ("2", "7", "", "bad"),
            ("2", "7", "", "20,05"),
            ("01", "7", "", "99,00"),
        )
    )
    second = frame("id string, branch string, code_key string", ("27", "2", "7"))
    found = sales.add_achieved(people, sold, second)
    assert rows(found, "id", "achieved") == [("15", 3.3), ("17", 10.0), ("19", None), ("27", 20.05)]


def test_channel_share_goes_to_everyone_but_managers(spark, frame):
    people = frame(
        PERSON + ", achieved double",
        (*person(5), 10.0),
        (*person(6, "GERENTE"), 10.0),
        (*person(7), None),
        (*person(8, branch=2), 3.0),
    )
    tab = frame("Filial string, `40% VT` string", (" 1", "1,005"), ("1", "2,00"), ("2", ""))
    shares = tabs.channel_shares(tab, spark)
    found = sales.add_channel_share(people, shares)
    assert rows(found, "id", "achieved_app") == [
        ("15", 13.0),
        ("16", 10.0),
        ("17", 3.0),
        ("28", 3.0),
    ]
    without = sales.add_channel_share(people, tabs.channel_shares(None, spark))
    assert rows(without.where(F.col("achieved_app").eqNullSafe(F.col("achieved"))), "id") == rows(
        people, "id"
    )


@pytest.mark.parametrize(
    "achieved,target,progress",
    [(50.0, 200.0, 25.0), (None, 200.0, 0.0), (1.0, 0.0, None), (1.0, None, None), (1.0, 3.0, 33.33)],
)
def test_progress(frame, achieved, target, progress):
    df = frame("achieved_app double, target double", (achieved, target))
    assert payout.add_progress(df).first()["progress"] == progress


RATIOS = {
    0.7999: (5.0, None, 5.0),
    0.80: (10.01, None, 10.01),
    1.0499: (10.01, None, 10.01),
    1.05: (10.01, 75.0, 85.01),
    1.0999: (10.01, 75.0, 85.01),
    1.10: (10.01, 150.0, 160.01),
}


def paid(spark, people, commissions, trainees=()):
    ids = spark.createDataFrame([(i,) for i in trainees], "id string")
    earned = spark.createDataFrame(commissions, "branch_key string, code_key string, amount double")
    found = payout.add_payout(people, earned, ids)
    return {r.id: (r.accrued, r.paid, r.bonus, r.total) for r in found.collect()}


@pytest.mark.parametrize("ratio", list(RATIOS))
def test_payout_steps(spark, frame, ratio):
    people = frame(PERSON + ", target double, achieved_app double", (*person(5), 10000.0, ratio * 10000))
    found = paid(spark, people, [("1", "5", 4.01), ("2", "5", 6.0), ("2", "5", None)])
    half = RATIOS[ratio]
    assert found["15"] == (10.01, *half)


def test_paid_is_rounded_but_the_total_is_not_twice(spark, frame):
    """Half of 0.05 is 0.025, paid as 0.03 or 0.02, while the total starts from 0.025."""
    people = frame(PERSON + ", target double, achieved_app double", (*person(5), 100.0, 1.0))
    assert paid(spark, people, [("1", "5", 0.05)])["15"] == (0.05, round(0.025, 2), None, round(0.025, 2))


def test_who_is_not_paid_from_commission(spark, frame):
    schema = PERSON + ", target double, achieved_app double"
    people = frame(
        schema,
        (*person(1), None, 90.0),
        (*person(2), 0.0, 90.0),
        (*person(3), 100.0, 90.0),
        (*person(4, "GERENTE"), 100.0, 90.0),
        (*person(5, "SUBGERENTE"), 100.0, 90.0),
        (*person(6), 100.0, None),
        (*person(7), 100.0, 90.0),
    )
    earned = [("1", str(n), 10.0) for n in (1, 2, 4, 5, 6)] + [("1", "7", 0.0)]
    found = paid(spark, people, earned, trainees=["15"])
    nothing = (None, None, None)
    assert found["11"] == (10.0, *nothing) and found["12"] == (10.0, *nothing)
    assert found["13"] == (None, *nothing) and found["17"] == (None, *nothing)
    assert found["14"] == (10.0, *nothing)
    assert found["15"] == (10.0, 10.0, None, 10.0)
    assert found["16"] == (10.0, 5.0, None, 5.0)


def test_scorecard_pays_managers_and_adds_to_trainees(frame):
    schema = PERSON + ", is_trainee boolean, accrued double, paid double, bonus double, total double"
    people = frame(
        schema,
        (*person(1, "GERENTE"), False, 1.0, None, None, None),
        (*person(2, "GERENTE"), True, 1.0, 1.0, 75.0, 76.0),
        (*person(3), True, None, None, None, None),
        (*person(4), False, 1.0, 1.0, None, 1.0),
        (*person(5, "GERENTE", 9), False, 1.0, None, None, None),
    )
    rewards = frame("branch_key string, reward double", ("1", 500.125))
    found = {
        r.id: (r.accrued, r.paid, r.bonus, r.total)
        for r in payout.apply_scorecard(people, rewards).collect()
    }
    assert found == {
        "11": (None, None, None, 500.12),
        "12": (1.0, 1.0, 75.0, 576.12),
        "13": (None, None, None, 500.12),
        "14": (1.0, 1.0, None, 1.0),
        "95": (1.0, None, None, None),
    }


def test_remaining_and_daily(frame):
    df = frame(
        "id int, target double, achieved double",
        (1, 100.0, 40.0),
        (2, 100.0, None),
        (3, None, 5.0),
        (4, 100.0, 130.0),
        (5, 0.0, 0.0),
    )
    left = payout.add_daily_recommended(payout.add_remaining(df), "2026-02-10")
    assert rows(left, "id", "remaining", "daily_recommended") == [
        (1, 60.0, 3.16),
        (2, 100.0, 5.26),
        (3, None, None),
        (4, -30.0, None),
        (5, 0.0, None),
    ]


def test_single_payout(frame):
    people = frame(
        PERSON + ", target double, achieved double",
        (*person(1), 100.0, 79.0),
        (*person(2), 100.0, 106.0),
        (*person(3), 0.0, 106.0),
        (*person(4), 100.0, 106.0),
    )
    earned = frame(
        "branch_key string, code_key string, amount double",
        ("01", "1", 10.0),
        ("1", "1", 20.0),
        ("02", "2", 10.0),
        ("1", "2", 7.0),
        ("1", "3", 7.0),
    )
    found = payout.add_single_payout(people, earned)
    assert rows(found, "id", "payout") == [
        ("11", 10.0),
        ("11", 5.0),
        ("12", 82.0),
        ("13", None),
        ("14", None),
    ]


def reward(frame, function, *values):
    names = ["a", "b", "c"][: len(values)]
    df = frame(", ".join(f"{n} double" for n in names), values)
    return df.select(function(*[F.col(n) for n in names])).first()[0]


@pytest.mark.parametrize(
    "percent,expected", [(99.99, None), (100, 200.0), (102, 250.0), (103.99, 250.0), (104, 300.0)]
)
def test_revenue_steps(frame, percent, expected):
    steps = lambda a, t: scorecard.percent_reward(a, t, scorecard.vocab.REVENUE_STEPS)
    assert reward(frame, steps, float(percent), 100.0) == expected
    assert reward(frame, steps, float(percent), 0.0) is None
    assert reward(frame, steps, None, 100.0) is None


@pytest.mark.parametrize("percent,expected", [(99.9, None), (100, 200.0), (105, 250.0), (110, 300.0)])
def test_ticket_steps(frame, percent, expected):
    steps = lambda a, t: scorecard.percent_reward(a, t, scorecard.vocab.TICKET_STEPS)
    assert reward(frame, steps, float(percent), 100.0) == expected


@pytest.mark.parametrize(
    "points,expected", [(-2, 300.0), (-1.99, 250.0), (-1, 250.0), (0, 200.0), (0.004, 200.0), (0.01, None)]
)
def test_cost_steps(frame, points, expected):
    assert reward(frame, scorecard.cost_reward, 50.0 + points, 100.0, 50.0) == expected


def test_cost_without_revenue(frame):
    assert reward(frame, scorecard.cost_reward, 5.0, 0.0, 50.0) is None
    assert reward(frame, scorecard.cost_reward, 0.0, 0.0, 50.0) is None
    assert reward(frame, scorecard.cost_reward, -5.0, 0.0, 50.0) == 300.0


@pytest.mark.parametrize(
    "revenue,target,expected",
    [(100.0, 100.0, 10.0), (99.0, 100.0, 5.0), (1.0, 0.0, 10.0), (0.0, 0.0, 5.0), (None, 1.0, None), (1.0, None, None)],
)
def test_commission_share(frame, revenue, target, expected):
    assert reward(frame, scorecard.commission_reward, 100.0, revenue, target) == expected


def test_scorecard_matches_branches_and_takes_first_rows(spark, frame):
    sold = frame(
        "Filial string, `Faturamento HB` string, `Custo Total` string, `Faturamento Total` string,"
        " `Ticket Médio` string, row_idx bigint",
        ("F01", "10,00", "50,00", "104,00", "11,00", 1),
        ("1", "0,00", "0,00", "0,00", "0,00", 2),
        ("7", "", "", "90,00", "", 3),
        ("12", "", "", "90,00", "", 4),
        ("9", "", "", "90,00", "", 5),
    )
    target = frame(
        "Filial string, Number string, HB string, `TKT MÉDIO` string, CMV string, row_idx bigint",
        ("1.0", "100,00", "10,00", "10,00", "50,1%", 0),
        ("01", "1,00", "1,00", "1,00", "1%", 1),
        ("7", "100,00", "", "", "", 2),
        ("12", "90,00", "", "", "", 3),
    )
    earned = frame(
        "Filial string, `Código` string, `Valor Comissão` string",
        ("01", "5", "100,00"),
        ("01", "6", "bad"),
        ("7", "5", "10,00"),
        ("07", "5", "1.000,00"),
        ("12", "5", "bad"),
    )
    card = scorecard.build_scorecard(
        tabs.branch_sales(sold), tabs.branch_targets(target), tabs.commissions(earned)
    )
    assert rows(card) == [
        ("1", 300.0, 300.0, 200.0, 300.0, 10.0),
        ("12", 200.0, None, None, None, 0.0),
        ("7", None, None, None, None, 0.5),
        ("9", None, None, None, None, None),
    ]
    rewards = {r.branch_key: r.reward for r in scorecard.branch_rewards(card).collect()}
    assert rewards == {"1": 1110.0, "12": 200.0, "7": 0.5, "9": 0.0}
