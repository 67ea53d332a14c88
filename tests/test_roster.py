from balcao.operators import roster
from balcao.sources import tabs
from tests.conftest import rows

PEOPLE = "branch string, code string, name string, title string"
ROSTER = "id string, branch bigint, code bigint, name string, role string"


def test_roster_keeps_commissioned_roles(frame):
    people = frame(
        PEOPLE,
        ("F01", "20.0", "Ana", "12 - GERENTE"),
        ("2", "21", "Bia", "farmaceutico"),
        ("3", "22", "Caio", "1 - REPOSITOR"),
    )
    assert rows(roster.build_roster(people)) == [
        ("120", 1, 20, "Ana", "GERENTE"),
        ("221", 2, 21, "Bia", "FARMACEUTICO"),
    ]


def test_bad_branch_fails_the_job(frame):
    people = frame(PEOPLE, ("MATRIZ", "20", "Ana", "GERENTE"))
    try:
        roster.build_roster(people).collect()
    except Exception as error:
        assert "not a branch number" in str(error)
    else:
        raise AssertionError("a bad branch went through")


def second(spark, *lines):
    columns = "ID string, Filial string, `Código` string, Colaborador string"
    return tabs.second_targets(spark.createDataFrame(list(lines), columns), spark)


def test_second_targets(spark, frame):
    base = frame(
        ROSTER,
        ("35", 3, 5, "Zoe", "GERENTE"),
        ("25", 2, 5, "Zoe", "FARMACEUTICO"),
        ("17", 1, 7, "Ana", "GERENTE"),
    )
    listed = second(
        spark,
        ("17", "1", "7", "already there"),
        (" 95 ", "9", "5.0", "copied from the lowest branch"),
        ("95", "9", "5", "listed twice"),
        ("88", "8", "8", "nobody has this code"),
    )
    found = roster.add_second_targets(base, listed)
    assert rows(found) == sorted(
        [
            *rows(base),
            ("95", 9, 5, "Zoe", "FARMACEUTICO"),
            ("95", 9, 5, "Zoe", "FARMACEUTICO"),
        ],
        key=repr,
    )
    assert rows(roster.add_second_targets(base, second(spark, ("17", "1", "7", "x")))) == rows(base)


def test_leave_compares_branch_as_text(spark, frame):
    base = frame(
        ROSTER,
        ("17", 1, 7, "Ana ", "GERENTE"),
        ("18", 1, 8, "Bia", "GERENTE"),
        ("29", 2, 9, "Caio", "GERENTE"),
    )
    tab = frame(
        "Filial string, Colaborador string, Motivo string",
        (" 1", "ana", "x"),
        ("1", "ANA", "y"),
        ("01", "bia", "z"),
        ("1", "caio", "other branch"),
    )
    found = roster.drop_on_leave(base, tabs.leave(tab, spark))
    assert rows(found, "id", "name") == [("18", "BIA"), ("29", "CAIO")]
    assert found.columns == base.columns


def test_last_filled_value_is_carried_forward(spark, frame):
    base = frame(ROSTER, ("17", 1, 7, "A", "G"), ("18", 1, 8, "B", "G"), ("19", 1, 9, "C", "G"))
    previous = frame(
        "ID string, Meta string, row_idx bigint",
        ("17", "1.000,00", 0),
        (" 17", "2.000,00", 1),
        ("17", " ", 2),
        ("18", "", 3),
        ("19", "abc", 4),
        ("", "5", 5),
    )
    found = roster.carry_forward(base, tabs.previous_values(previous, "Meta", spark), "target")
    assert rows(found, "id", "target_text", "target") == [
        ("17", "2.000,00", 2000.0),
        ("18", None, None),
        ("19", "abc", None),
    ]


def test_drop_person_and_collisions(frame):
    base = frame(ROSTER, ("123", 1, 23, "Ana", "G"), ("123", 12, 3, "Bia", "G"), ("5", 0, 5, None, "G"))
    assert rows(roster.drop_person(base, " ana "), "code") == [(3,), (5,)]
    assert rows(roster.id_collisions(base)) == [("123", 2, 1, 12)]
