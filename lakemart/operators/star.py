"""Star-schema loading: date dimension, dimensions with surrogate keys,
fact with key lookups, and the star reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import MONEY, money_sum
from lakemart.operators.ranking import assign_keys, latest_per_key


def date_key(c: str | Column) -> Column:
    """``yyyyMMdd`` as an INT."""
    d = (F.col(c) if isinstance(c, str) else c).cast("date")
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def dim_date_between(start: Column, end: Column, frame: DataFrame) -> DataFrame:
    """One row per calendar day from ``start`` to ``end`` (scalar columns).

    The row count is the length of the calendar span, not the data volume.
    """
    days = frame.sparkSession.range(1).select(
        F.explode(F.sequence(start.cast("date"), end.cast("date"), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        date_key("full_date").alias("date_key"), "full_date",
        (F.dayofweek("full_date") - 1).cast("int").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.month("full_date").cast("int").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").cast("int").alias("quarter"),
        F.year("full_date").cast("int").alias("year"))


def dim_date_for(df: DataFrame, col: str) -> DataFrame:
    """Date dimension covering the dates present in ``df.col``."""
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    return dim_date_between(lo, hi, df)


def load_dim(raw: DataFrame, natural_key: str, attrs: Sequence[str], key_col: str,
             order: Sequence[str] | None = None, at_most: int | None = None) -> DataFrame:
    """Distinct attributes per natural key (one row per key), numbered with
    surrogate keys in ``order`` (default: the natural key). ``at_most``: a
    known bound of the number of keys."""
    one = latest_per_key(raw.select(natural_key, *attrs), [natural_key], list(attrs))
    ordering = [(c, "asc") for c in (order or [natural_key])]
    if natural_key not in (order or []):
        ordering.append((natural_key, "asc"))
    return assign_keys(one, key_col, ordering, at_most=at_most).select(key_col, natural_key, *attrs)


def load_fact(raw: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, *,
              date_col: str, customer_id: str, product_id: str, price: str, quantity: str,
              keep: Sequence[str], sale_key: str | None = "sale_key", order: Sequence[str] = (),
              key_rows: DataFrame | None = None) -> DataFrame:
    """Fact rows with dimension keys looked up and ``total_amount = price × qty``.

    Lookups are left joins, so rows without a dimension match are kept with
    a NULL key and ``matched = false`` (the written INSERT .. JOIN drops them).
    The date key is computed (``yyyyMMdd``), which equals the date-dimension lookup.
    ``sale_key=None`` skips the identity column (a global numbering pass)
    for callers that only aggregate the fact. ``key_rows``: the source lines
    with the leading columns of ``order``, one row per fact row, from which
    the numbering takes its bounds and counts without the lookups.
    """
    dc = dim_customer.select("customer_key", F.col(customer_id).alias("_cid"))
    dp = dim_product.select("product_key", F.col(product_id).alias("_pid"))
    f = (raw.join(dc, raw[customer_id] == dc["_cid"], "left")
         .join(dp, raw[product_id] == dp["_pid"], "left"))
    f = f.select(date_key(date_col).alias("date_key"), "customer_key", "product_key", *keep,
                 F.col(quantity).cast("int").alias("quantity"),
                 (F.col(price).cast(MONEY) * F.col(quantity)).cast(MONEY).alias("total_amount"),
                 (F.col("customer_key").isNotNull() & F.col("product_key").isNotNull()).alias("matched"))
    if sale_key is None:
        return f
    return assign_keys(f, sale_key, [(c, "asc") for c in order] or [(c, "asc") for c in keep], key_rows=key_rows)


def sales_by_category(fact: DataFrame, dim_product: DataFrame, category: str = "category",
                      key: str = "product_key") -> DataFrame:
    """Sales and units per product category; ``key`` is the surrogate or the natural product key.

    The fact is first reduced to one row per product key (partial
    aggregation map-side), so the dimension join sees one row per product
    instead of one per sale.
    """
    per_product = fact.groupBy(key).agg(F.sum("total_amount").alias("_amt"),
                                                  F.sum("quantity").alias("_qty"))
    return (per_product.join(dim_product.select(key, category), key)
            .groupBy(category).agg(money_sum("_amt").alias("total_sales"),
                                   F.sum("_qty").cast("bigint").alias("units")))


def monthly_by_country(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame,
                       country: str = "country", key: str = "customer_key") -> DataFrame:
    """Sales per year, month and customer country (month kept in the grouping);
    ``key`` is the surrogate or the natural customer key.

    Reduced to (date, customer) before the joins; the date dimension has one
    row per calendar day, a proven broadcast bound.
    """
    per = fact.groupBy("date_key", key).agg(F.sum("total_amount").alias("_amt"))
    dd = F.broadcast(dim_date.select("date_key", "year", "month"))
    return (per.join(dd, "date_key").join(dim_customer.select(key, country), key)
            .groupBy("year", "month", country).agg(money_sum("_amt").alias("total_sales")))


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = 5, key: str = "customer_key") -> DataFrame:
    """Top ``k`` customers by sales (ties by natural key), fact reduced per key first."""
    per = fact.groupBy(key).agg(money_sum("total_amount").alias("total_sales"))
    return (per.join(dim_customer, key)
            .select("customer_id", "customer_name", "total_sales")
            .orderBy(F.desc("total_sales"), F.asc("customer_id")).limit(k))
