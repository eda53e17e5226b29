"""CRM lead KPIs. Input: region, status, created_date, deal_value, source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import avg_exact, count_when, money_sum, ratio


def top_regions_converted(leads: DataFrame, regions: Sequence[str], as_of: Column, k: int = 5,
                          converted: str = "converted") -> DataFrame:
    """Converted leads created in the month of ``as_of`` per allowed region, top ``k``.

    When the frame carries the raw ``created_ts``, the month window is written
    on it (``>= month start``, ``< as_of + 1 day``) so the range reaches the
    scan as a pushed filter; a predicate on the derived date could not.
    """
    if "created_ts" in leads.columns:
        start = F.trunc(as_of, "month").cast("timestamp_ntz")
        end = F.date_add(as_of, 1).cast("timestamp_ntz")
        this_month = (F.col("created_ts") >= start) & (F.col("created_ts") < end)
    else:
        this_month = (F.col("created_date") >= F.trunc(as_of, "month")) & (F.col("created_date") <= as_of)
    return (leads.where(this_month & F.col("region").isin(list(regions)) & (F.col("status") == converted))
            .groupBy("region").agg(F.count(F.lit(1)).alias("converted_leads"))
            .where(F.col("converted_leads") > 0)
            .orderBy(F.desc("converted_leads"), F.asc("region")).limit(k))


def lead_metrics(leads: DataFrame, converted: str = "converted") -> DataFrame:
    """Per region: leads, converted, conversion % and mean positive deal value."""
    return leads.groupBy("region").agg(
        F.count(F.lit(1)).alias("total_leads"),
        count_when(F.col("status") == converted).alias("converted"),
        avg_exact(F.when(F.col("deal_value") > 0, F.col("deal_value")), 2, 2).alias("avg_deal_value"),
    ).withColumn("conversion_rate_pct", ratio("converted", "total_leads", 2, pct=True))


def conversion_rate(leads: DataFrame, converted: str = "converted") -> DataFrame:
    """One row over all regions: leads, converted leads and conversion %."""
    return leads.agg(F.count(F.lit(1)).alias("total_leads"),
                     F.count(F.when(F.col("status") == converted, 1)).alias("converted")
                     ).withColumn("conversion_rate_pct", ratio("converted", "total_leads", 2, pct=True))


def high_value_deals(leads: DataFrame, threshold: float) -> DataFrame:
    """Deals above ``threshold`` per source: count and total value."""
    return (leads.where(F.col("deal_value") > F.lit(threshold)).groupBy("source")
            .agg(F.count(F.lit(1)).alias("high_value_deals"), money_sum("deal_value").alias("total_value")))
