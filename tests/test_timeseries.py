"""Period deltas, running totals and rolling sums on a series with a missing month."""

from datetime import date

from lakemart.operators import timeseries


def _series(spark):
    rows = [(date(2022, 11, 1), 10), (date(2022, 12, 1), 20), (date(2023, 1, 1), 30),
            (date(2023, 3, 1), 40)]  # February missing
    return spark.createDataFrame(rows, "month date, revenue long")


def test_delta_and_running(spark):
    df = _series(spark)
    d = {r.month: (r.prev_value, r.delta) for r in timeseries.period_delta(df, "month", "revenue").collect()}
    assert d[date(2022, 11, 1)] == (None, None) and d[date(2023, 3, 1)] == (30, 10)
    run = {r.month: r.running_total for r in timeseries.running_total(df, "month", "revenue").collect()}
    assert run[date(2023, 3, 1)] == 100  # as written: never resets
    ytd = {r.month: r.running_total for r in timeseries.running_total(df, "month", "revenue", reset="year").collect()}
    assert ytd[date(2023, 1, 1)] == 30 and ytd[date(2023, 3, 1)] == 70 and ytd[date(2022, 12, 1)] == 30


def test_rolling_rows_vs_calendar(spark):
    df = _series(spark)
    rows = {r.month: r.rolling_sum for r in timeseries.rolling_sum(df, "month", "revenue", 3, "rows").collect()}
    cal = {r.month: r.rolling_sum for r in timeseries.rolling_sum(df, "month", "revenue", 3, "calendar").collect()}
    assert rows[date(2023, 3, 1)] == 90   # Dec, Jan, Mar: the gap stretches the span
    assert cal[date(2023, 3, 1)] == 70    # Jan..Mar only


def test_by_category(spark):
    df = spark.createDataFrame([("a", date(2023, 1, 1), 1), ("a", date(2023, 2, 1), 4), ("b", date(2023, 2, 1), 7)],
                               "cat string, month date, v long")
    out = {(r.cat, r.month): r.delta for r in timeseries.period_delta(df, "month", "v", by="cat").collect()}
    assert out[("a", date(2023, 2, 1))] == 3 and out[("b", date(2023, 2, 1))] is None
