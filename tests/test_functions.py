"""Column helpers."""

from datetime import datetime

from pyspark.sql import functions as F

from lakemart.functions.columns import band, null_token, scalar_lit, within_days


def test_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in (10.0, 50.0, 50.01, 100.0, 100.5)], "p double")
    got = [r.b for r in df.select(band("p", (50, 100), ("Low", "Medium", "High")).alias("b")).collect()]
    assert got == ["Low", "Low", "Medium", "Medium", "High"]  # strictly greater than each edge


def test_within_days_and_scalar_lit(spark):
    rows = [(datetime(2024, 1, d, 12),) for d in (1, 20, 24, 31)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    as_of = scalar_lit(df.select(F.max("ts")))
    assert df.select(as_of.alias("a")).first().a == datetime(2024, 1, 31, 12)   # wall clock kept exactly
    kept = sorted(r.ts.day for r in df.where(within_days("ts", 7, as_of)).collect())
    assert kept == [24, 31]


def test_null_token_keeps_other_values(spark):
    df = spark.createDataFrame([("  unknown ",), ("Known",), (None,)], "s string")
    assert [r.s for r in df.select(null_token("s", ["UNKNOWN"]).alias("s")).collect()] == [None, "Known", None]
