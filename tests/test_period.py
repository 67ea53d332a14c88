import datetime as dt

from pyspark.sql import functions as F

from balcao.functions import period


def test_periods(spark):
    days = {
        "2026-03-01": ("2026-02-01", "2026-02-28", 31, "04/2026"),
        "2026-03-02": ("2026-03-01", "2026-03-02", 30, "04/2026"),
        "2026-01-01": ("2025-12-01", "2025-12-31", 31, "02/2026"),
        "2024-03-01": ("2024-02-01", "2024-02-29", 31, "04/2024"),
        "2026-02-10": ("2026-02-01", "2026-02-10", 19, "03/2026"),
        "2026-12-31": ("2026-12-01", "2026-12-31", 1, "01/2027"),
    }
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    found = df.select(
        "d",
        period.period_start(F.col("d")),
        period.period_end(F.col("d")),
        period.days_left(F.col("d")),
        period.next_month_label(F.col("d")),
    ).collect()
    assert {str(r[0]): (str(r[1]), str(r[2]), r[3], r[4]) for r in found} == days


def test_period_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "sales")
    spark.sql("SELECT timestamp_ntz'1998-06-03 10:00:00' AS at, 1 AS v").write.parquet(path)
    df = spark.read.parquet(path).where(period.in_period(F.col("at"), "1998-06-20"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "GreaterThanOrEqual(at,1998-06-01" in pushed and "LessThan(at,1998-06-21" in pushed
    assert df.count() == 1
