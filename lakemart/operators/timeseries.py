"""Period-over-period, running and rolling aggregates over a period series.

The inputs are per-period aggregates (one row per month, or per month and
category), so a window ordered by period holds at most one row per
calendar period per series: its size is bounded by the calendar, not by
the data volume. Series with a ``by`` key are partitioned on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _window(period: str, by):
    w = Window.partitionBy(*_by(by)) if _by(by) else Window.partitionBy()
    return w.orderBy(F.col(period))


def period_delta(df: DataFrame, period: str, value: str, by=None,
                 prev: str = "prev_value", delta: str = "delta") -> DataFrame:
    """``LAG(value)`` and ``value - LAG(value)`` per series."""
    w = _window(period, by)
    return (df.withColumn(prev, F.lag(F.col(value)).over(w))
              .withColumn(delta, F.col(value) - F.col(prev)))


def running_total(df: DataFrame, period: str, value: str, by=None, reset: str | None = None,
                  out: str = "running_total") -> DataFrame:
    """``SUM(value) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING)``.

    ``reset="year"`` restarts the sum each calendar year (a true YTD);
    ``reset=None`` keeps one unbroken running sum, as the written query does.
    """
    keys = _by(by)
    if reset == "year":
        keys = keys + ["_lm_year"]
        df = df.withColumn("_lm_year", F.year(F.col(period)))
    elif reset is not None:
        raise ValueError(reset)
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy(F.col(period)) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out_df = df.withColumn(out, F.sum(F.col(value)).over(w))
    return out_df.drop("_lm_year") if reset == "year" else out_df


def rolling_sum(df: DataFrame, period: str, value: str, n: int = 3, frame: str = "rows",
                by=None, out: str = "rolling_sum") -> DataFrame:
    """Sum over the current and ``n-1`` previous periods.

    ``frame="rows"`` counts rows (a missing month stretches the span, as
    written); ``frame="calendar"`` counts calendar months via a RANGE frame
    on a month index.
    """
    keys = _by(by)
    base = Window.partitionBy(*keys) if keys else Window.partitionBy()
    if frame == "rows":
        w = base.orderBy(F.col(period)).rowsBetween(-(n - 1), Window.currentRow)
        return df.withColumn(out, F.sum(F.col(value)).over(w))
    if frame == "calendar":
        idx = F.year(F.col(period)) * 12 + F.month(F.col(period))
        w = base.orderBy(F.col("_lm_midx")).rangeBetween(-(n - 1), Window.currentRow)
        return df.withColumn("_lm_midx", idx).withColumn(out, F.sum(F.col(value)).over(w)).drop("_lm_midx")
    raise ValueError(frame)
