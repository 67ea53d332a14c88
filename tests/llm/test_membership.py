"""A prefilter that loses no wanted row and lets few others pass."""

from pyspark.sql import functions as F

from balcao.llm import membership
from balcao.llm.membership import likely_members


def test_wanted_rows_pass_and_few_others(spark, monkeypatch):
    rows = spark.range(-5_000, 50_000).select(F.col("id").alias("key"), F.lit("x").alias("a.b"))
    rows = rows.unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("key"), F.lit("x").alias("a.b")))
    wanted = spark.range(0, 50_000, 9).select(F.col("id").alias("id"))
    for bits, others in ((1 << 26, 100), (1 << 17, 4_000)):
        monkeypatch.setattr(membership, "BITS", bits)
        found = likely_members(rows, "key", wanted, "id")
        assert found.columns == ["key", "a.b"]
        keys = {r.key for r in found.collect()}
        assert set(range(0, 50_000, 9)) <= keys and len(keys) <= 5_556 + others
        assert None in {r.key for r in likely_members(rows, "key", wanted.where("id < 9").union(rows.where("key is null").select("key")), "id").collect()}
    assert likely_members(rows, "key", wanted.where("false"), "id").isEmpty()
    assert "Exchange hashpartitioning(key" not in found._jdf.queryExecution().executedPlan().toString()
