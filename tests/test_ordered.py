"""Row-order operators against plain loops, with chunks far smaller than the files."""

import random
import re

import pytest
from pyspark.sql import functions as F

from balcao.operators.ordered import fill_down, running_last, running_total, shift_up
from tests.conftest import rows

SCHEMA = "file string, row_idx bigint, kind string, v string"


def random_files(seed, files=5, length=60):
    """Files with gaps in their row numbers; one file is much longer than the others."""
    rng = random.Random(seed)
    out = []
    for f in range(files):
        at = 0
        for _ in range(length * 8 if f == 0 else length):
            at += rng.choice([1, 1, 1, 2, 7, 40])
            value = rng.choice([None, "a", "b", "c"])
            out.append((f"f{f}", at, rng.choice(["m", "x", "y", "z"]), value))
    rng.shuffle(out)
    return out


def per_file(data):
    by_file = {}
    for row in sorted(data, key=lambda r: (r[0], r[1])):
        by_file.setdefault(row[0], []).append(row)
    return by_file.values()


@pytest.mark.parametrize("chunk", [1, 7, 100, 10**9])
def test_fill_down_matches_a_loop(spark, chunk):
    data = random_files(chunk)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    expected = []
    for file_rows in per_file(data):
        current = None
        for f, at, kind, v in file_rows:
            if kind == "m":
                current = v
            expected.append((f, at, current))
    found = fill_down(df, F.col("kind") == "m", F.col("v"), "section", chunk)
    assert rows(found, "file", "row_idx", "section") == sorted(expected, key=repr)
    assert found.columns == [*df.columns, "section"]


@pytest.mark.parametrize("chunk", [3, 50])
def test_running_last_strictly_before_tells_null_from_nothing(spark, chunk):
    data = random_files(99)
    df = spark.createDataFrame(data, SCHEMA)
    expected = []
    for file_rows in per_file(data):
        last = None
        for f, at, kind, v in file_rows:
            expected.append((f, at, last))
            if kind == "m":
                last = (at, v)
    found = running_last(df, {"last": (F.col("kind") == "m", F.col("v"))}, True, chunk)
    got = [
        (r.file, r.row_idx, None if r["last"] is None else tuple(r["last"])) for r in found.collect()
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("chunk", [2, 33, 10**6])
def test_shift_up_matches_a_loop(spark, chunk):
    data = random_files(5)
    df = spark.createDataFrame(data, SCHEMA)
    expected = []
    for file_rows in per_file(data):
        for row, below in zip(file_rows, [*file_rows[1:], (None,) * 4], strict=True):
            expected.append((row[0], row[1], row[2], below[3]))
    found = shift_up(df, ["v"], chunk)
    assert rows(found, "file", "row_idx", "kind", "v") == sorted(expected, key=repr)


@pytest.mark.parametrize("chunk", [1, 20])
def test_running_total_counts_rows_above(spark, chunk):
    data = random_files(11)
    df = spark.createDataFrame(data, SCHEMA)
    expected = []
    for file_rows in per_file(data):
        for i, row in enumerate(file_rows):
            expected.append((row[0], row[1], i))
    found = running_total(df, F.lit(1), "above", chunk)
    assert rows(found, "file", "row_idx", "above") == sorted(expected, key=repr)


def test_one_file_is_spread_over_many_groups(spark):
    """The windows are per (file, chunk): no file ends up in one group."""
    df = spark.range(1000).selectExpr(
        "concat('hot', id div 1000) AS file", "id AS row_idx", "'x' AS kind", "'' AS v"
    )
    found = fill_down(df, F.col("kind") == "m", F.col("v"), "section", 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(file#\d+, __chunk#\d+L", plan)
    assert "SinglePartition" not in plan
    assert found.where("section IS NULL").count() == 1000


def test_heads_of_chunks_are_found_by_numbers_alone(spark):
    """Values are looked up for chunks that have one behind them, not gathered for all."""
    df = spark.createDataFrame(random_files(3), SCHEMA)
    plan = shift_up(df, ["v"], 33)._jdf.queryExecution().optimizedPlan().toString()
    assert "min(row_idx" in plan
    at = plan.index("min_by(")
    assert "Join Inner" in plan[at:]
