"""Every query against its SQL, and the shape of the plans."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from balcao.catalogue import all as catalogue
from tests.conftest import SMALL
from tools.compare import connect, differences

QUERIES = {name: query for name, query in queries().items() if name in catalogue.ALL}
SQL = {name: sql for name, sql in oracle_sql().items() if name in catalogue.ALL}
# The smallest tables hold no such rows.
MAY_BE_EMPTY = {"composite_id_collisions"}
# One row over the whole input: a single task at the end gets one row per task before it.
TOTALS = {"hb_duplicates", "people_match_stats"}
PLANNED = (
    "payout_final",
    "branch_scorecard",
    "seller_payout",
    "flatten_sellers",
    "flatten_commissions",
    "branch_totals_report",
    "shift_channel_report",
    "shift_pos_staff",
    "people_match",
    "people_profile",
    "hb_sales_dedup",
    "roster_leave_anti",
    "reporting_period_sales",
)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "id" and not df.isEmpty()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    found = differences(spark, duck, SMALL, QUERIES[name], SQL[name])
    if name in MAY_BE_EMPTY:
        found = [f for f in found if f != "no rows on either side"]
    assert found == []


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_distributed_and_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoop", "SinglePartition"):
        assert unwanted not in plan, f"{unwanted} in the plan of {name}"


@pytest.mark.parametrize(("name", "exchanges"), [("payout_final", 28), ("branch_scorecard", 13), ("shift_channel_report", 10)])
def test_plans_need_few_exchanges(spark, name, exchanges):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(" Exchange " in line or "- Exchange" in line for line in plan.splitlines()) <= exchanges


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["sales_by_branch_seller"](spark, SMALL)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in text
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_period_filter_reaches_the_orders_scan(spark):
    plan = QUERIES["reporting_period_sales"](spark, SMALL)._jdf.queryExecution().executedPlan()
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01" in plan.toString()


def test_large_sides_are_not_broadcast(spark):
    """With the size limit for broadcasts at zero, every join still has another way."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["payout_final"](spark, SMALL)
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
        assert df.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rejected_files_hold_all_customers(spark):
    from balcao.catalogue.files import write_bad_hr_files

    lines = spark.read.option("recursiveFileLookup", True).text(write_bad_hr_files(spark, SMALL))
    wanted = spark.read.parquet(f"{SMALL}/customer.parquet").where("c_nationkey % 4 <> 2").count()
    assert lines.where("value like '%Customer#%'").count() == wanted > 0


def test_channel_lines_meet_their_headers_once(spark):
    files = QUERIES["shift_channel_report"](spark, SMALL).inputFiles()
    assert files and all("/lines-" in f for f in files)
