"""The integer HALF_UP helpers agree with Python's Decimal rounding."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakemart.functions.columns import avg_exact, ratio


def _half_up(num: int, den: int, scale: int) -> Decimal:
    return (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP) \
        if den else None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-5000, 5000)), min_size=40, max_size=40))
def test_ratio_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [tuple(r) for r in df.select("n", "d", ratio("n", "d", 4).alias("r"),
                                        ratio("n", "d", 2, pct=True).alias("p")).collect()]
    for n, d, r, p in got:
        if d == 0:
            assert r is None and p is None
        else:
            # Decimal division keeps 28 digits, ample for these magnitudes
            assert r == _half_up(n, d, 4) and p == _half_up(n * 100, d, 2), (n, d, r, p)


def test_avg_exact_ties(spark):
    vals = [Decimal("61.72"), Decimal("61.73")]           # mean 61.725 → 61.73 (HALF_UP)
    df = spark.createDataFrame([(v,) for v in vals], "v decimal(18,2)")
    assert df.agg(avg_exact("v", 2, 2)).first()[0] == Decimal("61.73")
    neg = spark.createDataFrame([(Decimal("-0.01"),), (Decimal("-0.02"),)], "v decimal(18,2)")
    assert neg.agg(avg_exact("v", 2, 2)).first()[0] == Decimal("-0.02")  # -0.015 → away from zero
    empty = df.where(F.lit(False))
    assert empty.agg(avg_exact("v", 2, 2)).first()[0] is None
