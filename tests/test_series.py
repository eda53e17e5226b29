"""Running and rolling sums in forced buckets against plain windows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakemart.operators import series


def _rows(seed=3, n=400):
    rnd = random.Random(seed)
    # one series holds two thirds of all rows; null keys are a series, values may be null
    return [(rnd.choice(["a", "a", "a", "a", "b", None]), rnd.choice([None, 1, 2, 2, 2, 3]), i,
             None if rnd.random() < 0.2 else Decimal(rnd.randrange(-900, 900)) / 100) for i in range(n)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(_rows(), "k string, t int, id int, v decimal(10,2)").repartition(5).cache()


def _window(by):
    return Window.partitionBy(*by).orderBy(F.asc_nulls_first("t"), "id")


@pytest.mark.parametrize("by", [[], ["k"], ["k", "t"]])
@pytest.mark.parametrize("buckets", [None, 2, 7, 60])
def test_running(frame, by, buckets):
    got = series.running_sum(frame, "v", ["t", "id"], by, out="s", num_partitions=buckets)
    want = frame.withColumn("s", F.sum("v").over(_window(by).rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted((r.id, r.s) for r in got.collect()) == sorted((r.id, r.s) for r in want.collect())
    assert got.columns == [*frame.columns, "s"]


@pytest.mark.parametrize("by,n,block,buckets", [([], 1, 10, 7), ([], 5, 10, 7), (["k"], 10, 10, 7), (["k"], 64, 10, 3), (["k"], 1000, 10, 5), (["k"], 7, 50_000, None)])
def test_rolling(frame, by, n, block, buckets):
    got = series.rolling_sum(frame, "v", ["t", "id"], n, by, out="s", num_partitions=buckets, block_rows=block)
    want = frame.withColumn("s", F.sum("v").over(_window(by).rowsBetween(1 - n, 0)))
    assert sorted((r.id, r.s) for r in got.collect()) == sorted((r.id, r.s) for r in want.collect())


def test_descending_and_whole_numbers(spark):
    df = spark.range(0, 50, 1, 4).select("id", (F.col("id") % 7).alias("v"))
    got = series.running_sum(df, "v", [("id", "desc")], out="s", num_partitions=6)
    assert {r.id: r.s for r in got.collect()} == {i: sum(j % 7 for j in range(i, 50)) for i in range(50)}


def test_empty_and_doubles(spark, frame):
    assert series.running_sum(frame.limit(0), "v", ["id"], num_partitions=4).count() == 0
    with pytest.raises(TypeError):
        series.running_sum(frame.withColumn("v", F.col("v").cast("double")), "v", ["id"])
