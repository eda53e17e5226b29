"""Distributed row numbers / ranks against a plain window, with a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators import ranking


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 40)}"   # one key holds a third of the rows
        rows.append((i, g, rnd.randint(0, 50), None if i % 97 == 0 else rnd.random()))
    return spark.createDataFrame(rows, "id long, g string, v int, w double")


def test_row_number_within_matches_window(spark):
    df = _frame(spark)
    ours = ranking.row_number_within(df, ["g"], [("v", "desc"), ("id", "asc")], out="rn", num_partitions=7)
    w = Window.partitionBy("g").orderBy(F.desc("v"), F.asc("id"))
    ref = df.withColumn("rn", F.row_number().over(w).cast("bigint"))
    assert sorted(map(tuple, ours.select("id", "rn").collect())) == sorted(map(tuple, ref.select("id", "rn").collect()))


def test_global_rank_with_ties(spark):
    df = _frame(spark)
    for method, fn in (("row_number", F.row_number), ("rank", F.rank)):
        ours = ranking.global_rank(df, [("v", "desc")], ["id"], method=method, out="r", num_partitions=5)
        order = [F.desc("v"), F.asc("id")] if method == "row_number" else [F.desc("v")]
        ref = df.withColumn("r", fn().over(Window.orderBy(*order)).cast("bigint"))
        assert sorted(map(tuple, ours.select("id", "r").collect())) == \
            sorted(map(tuple, ref.select("id", "r").collect()))


def test_null_keys_grouped(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a", i % 5) for i in range(40)], "id long, g string, v int")
    ours = ranking.row_number_within(df, ["g"], [("v", "asc"), ("id", "asc")], out="rn", num_partitions=3)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("bigint"))
    assert sorted(map(tuple, ours.select("id", "rn").collect())) == sorted(map(tuple, ref.select("id", "rn").collect()))


def test_rows_are_shuffled_once_and_not_checkpointed(spark, monkeypatch):
    """The last plan has one exchange of the rows, by bucket, and no pass is written out."""
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda *a, **k: pytest.fail("checkpoint"))
    df = _frame(spark)
    for out in (ranking.global_rank(df, [("v", "desc")], ["id"], out="r", num_partitions=5),
                ranking.global_rank(df, [("v", "desc")], method="rank", out="r", num_partitions=5),
                ranking.row_number_within(df, ["g"], [("v", "desc"), ("id", "asc")], out="r", num_partitions=5)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SinglePartition" not in plan and "Join" not in plan
        assert "hashpartitioning(_lm_bucket" in plan


@pytest.mark.parametrize("buckets", [1, 2, 3, 8, 50])
def test_groups_and_ties_across_many_buckets(spark, buckets):
    """Groups and ties that lie in several buckets, begin at a bound or fill whole buckets."""
    rows = [(i, [0, 0, 0, 0, 1, 2, 2, 3][i % 8] if i < 1600 else None, i // 700) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g int, v int")
    w = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"), "id")
    ref = df.withColumn("rn", F.row_number().over(w)).withColumn("rk", F.rank().over(Window.orderBy(F.desc_nulls_last("g"), "v")))
    want = sorted(map(tuple, ref.select("id", "rn", "rk").collect()))
    rn = ranking.row_number_within(df, ["g"], [("v", "desc"), ("id", "asc")], out="rn", num_partitions=buckets)
    rk = ranking.global_rank(df, [("g", "desc"), ("v", "asc")], method="rank", out="rk", num_partitions=buckets)
    assert sorted(map(tuple, rn.join(rk.select("id", "rk"), "id").select("id", "rn", "rk").collect())) == want


def test_keys_of_all_types_keep_their_exact_order(spark):
    df = spark.range(400).select(
        "id", F.expr("timestamp_micros(1700000000000000 + (id * 7919) % 400)").alias("ts"),
        F.expr("cast(timestamp_micros(1700000000000000 + (id * 7919) % 400) as timestamp_ntz)").alias("ntz"),
        F.expr("(id * 31 % 400) / 7d").alias("x"), F.expr("cast(id * 31 % 400 as decimal(38,10)) / 3").alias("d"),
        F.expr("case when id % 5 = 0 then cast('nan' as double) when id % 7 = 0 then double('-infinity') else id / 3d end").alias("odd"),
        F.expr("concat('a\"\\\\', char(id % 200 + 33))").alias("s"), F.expr("cast(id * 13 % 400 as string)").alias("t"),
        F.expr("date_add(date'1900-01-01', cast(id * 17 % 400 as int))").alias("day"), F.expr("encode(cast(id as string), 'utf-8')").alias("b"))
    for key in df.columns[1:]:
        for way in ("asc", "desc"):
            got = ranking.row_number_within(df, [], [(key, way), ("id", "asc")], out="rn", num_partitions=40)
            ref = df.withColumn("rn", F.row_number().over(Window.orderBy(
                F.desc_nulls_last(key) if way == "desc" else F.asc_nulls_first(key), "id")).cast("bigint"))
            assert dict(got.select("id", "rn").collect()) == dict(ref.select("id", "rn").collect()), (key, way)


def test_latest_per_key_is_an_aggregate(spark):
    df = _frame(spark)
    out = ranking.latest_per_key(df, ["g"], ["v", "id"])
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), F.desc("id")))) \
        .where("rn = 1").drop("rn")
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_hot_tie_is_split_over_partitions(spark):
    # every row ties on the order key: the internal tie-break must still spread them
    df = spark.range(0, 3000).select(F.col("id"), F.lit(1).alias("k"))
    out = ranking.row_number_within(df, [], [("k", "asc")], out="rn", num_partitions=6)
    parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
    assert sorted(r.rn for r in out.collect()) == list(range(1, 3001))
    assert parts > 1


def test_nan_and_null_float_keys(spark):
    rows = [(i, [float("nan"), None, 1.5][i % 3], i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, g double, v int")
    ours = ranking.row_number_within(df, ["g"], [("v", "asc"), ("id", "asc")], out="rn", num_partitions=4)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("bigint"))
    assert sorted(map(tuple, ours.select("id", "rn").collect())) == sorted(map(tuple, ref.select("id", "rn").collect()))


def test_sequence_spreads_large_keys_only(spark):
    df = _frame(spark).withColumn("g", F.when(F.col("g") != "g7", F.col("g")))
    order = [("v", "desc"), ("id", "asc")]
    ref = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), F.asc("id"))).cast("bigint"))
    want = sorted(map(tuple, ref.select("id", "seq").collect()))
    for most in (10_000, 500, 20):  # no large key, the hot key, and nearly all with the null key
        got = ranking.sequence_within(df, ["g"], order, max_rows=most)
        assert sorted(map(tuple, got.select("id", "seq").collect())) == want
