"""Plans that must share work."""

from __future__ import annotations

from lakemart.plans.registry import load_all

SF = "/root/testdata/sf0.001"


def test_big_spenders_sums_lines_once(spark):
    df = load_all()["big_spenders"].fn(spark, SF)
    df.collect()
    # only plans that ran show reuse; the subquery's average takes the shuffled sums per order of the join
    assert "ReusedExchange [order_id" in df._jdf.queryExecution().executedPlan().toString()


def test_bounds_take_as_few_keys_as_tell_them_apart(spark):
    from pyspark.sql import functions as F

    from lakemart.operators.ranking import _dealt, _keys

    df = spark.range(4000).select((F.col("id") % 2).alias("a"), (F.col("id") % 1000).alias("b"), F.col("id").alias("c"))
    assert len(_dealt(df, _keys(["a", "b", "c"]), 8, None, spread=False).keys) == 2
    assert len(_dealt(df, _keys(["c", "b", "a"]), 8, None, spread=False).keys) == 1
