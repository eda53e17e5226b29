"""Tap-event reports. Input: station_name, passengers, tap_ts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.functions.columns import avg_exact, money_sum, within_days


def top_stations(taps: DataFrame, days: int, min_events: int, as_of: Column, k: int = 5,
                 lo: float = 1, hi: float = 300) -> DataFrame:
    """Top ``k`` stations by passengers over the last ``days`` days.

    Valid passenger counts only, at least ``min_events`` taps per station.
    The rank is numbered after the top-k cut, so its window holds ``k`` rows.
    """
    valid = (F.col("station_name").isNotNull() & F.col("passengers").between(lo, hi)
             & within_days("tap_ts", days, as_of))
    top = (taps.where(valid).groupBy("station_name").agg(
        money_sum("passengers").alias("total_passengers"),
        F.count(F.lit(1)).alias("tap_events"),
        avg_exact("passengers", 2, 2).alias("avg_passengers_per_event"))
        .where(F.col("tap_events") > min_events)
        .orderBy(F.desc("total_passengers"), F.asc("station_name")).limit(k))
    w = Window.orderBy(F.desc("total_passengers"), F.asc("station_name"))
    return top.withColumn("rank", F.row_number().over(w).cast("bigint"))
