"""Relational and time-series queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import MONEY_SUM, money_sum
from lakemart.operators import ranking, relational, sales, series, timeseries
from lakemart.plans import tables as T
from lakemart.plans.registry import register
from lakemart.plans.sqlfrag import month, q, ratio


def as_money(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast(MONEY_SUM))
    return df


# ---------------------------------------------------------------- relational

@register("orders_without_lines", q("""
SELECT order_id, customer_id, status, purchase_ts FROM c_orders o
WHERE NOT EXISTS (SELECT 1 FROM c_items i WHERE i.order_id = o.order_id)"""))
def orders_without_lines(spark, d):
    o = T.orders(spark, d).select("order_id", "customer_id", "status", "purchase_ts")
    return relational.orders_without(o, T.items(spark, d), "order_id")


@register("orders_with_lines", q("""
SELECT order_id, customer_id, status, purchase_ts FROM c_orders o
WHERE EXISTS (SELECT 1 FROM c_items i WHERE i.order_id = o.order_id)"""))
def orders_with_lines(spark, d):
    o = T.orders(spark, d).select("order_id", "customer_id", "status", "purchase_ts")
    return relational.orders_with(o, T.items(spark, d), "order_id")


@register("segment_pairs", q("""
SELECT state, COUNT(DISTINCT customer_id) AS members,
  CAST(COUNT(DISTINCT customer_id) * (COUNT(DISTINCT customer_id) - 1) // 2 AS BIGINT) AS pairs
FROM c_customers GROUP BY state"""))
def segment_pairs(spark, d):
    return relational.pair_counts_within(T.customers(spark, d), "state", "customer_id")


@register("order_sequence", q("""
SELECT customer_id, order_id, purchase_ts,
  CAST(ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY purchase_ts, order_id) AS BIGINT) AS seq
FROM c_orders"""))
def order_sequence(spark, d):
    o = T.orders(spark, d).select("customer_id", "order_id", "purchase_ts")
    return ranking.sequence_within(o, ["customer_id"], [("purchase_ts", "asc"), ("order_id", "asc")], "seq")


@register("latest_line_per_key", q("""
SELECT order_id, line_no, shipped_ts, product_id, seller_id, quantity, price FROM c_items
QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id, line_no
  ORDER BY shipped_ts DESC, product_id DESC, seller_id DESC, quantity DESC, price DESC) = 1"""))
def latest_line_per_key(spark, d):
    i = T.items(spark, d).select("order_id", "line_no", "shipped_ts", "product_id", "seller_id",
                                 "quantity", "price")
    return ranking.latest_per_key(i, ["order_id", "line_no"],
                                  ["shipped_ts", "product_id", "seller_id", "quantity", "price"])


_SPEND_SQL = """, s AS (SELECT customer_id, CAST(SUM(order_total) AS DECIMAL(18,2)) AS total_spend,
  COUNT(*) AS n_orders FROM c_orders GROUP BY customer_id)"""


def _spend(spark, d):
    return sales.customer_spend(T.orders(spark, d))


@register("spend_row_number", q(_SPEND_SQL + """
SELECT customer_id, total_spend, n_orders,
  CAST(ROW_NUMBER() OVER (ORDER BY total_spend DESC, customer_id) AS BIGINT) AS spend_rank FROM s"""))
def spend_row_number(spark, d):
    return ranking.global_rank(_spend(spark, d), [("total_spend", "desc")], ["customer_id"],
                               method="row_number", out="spend_rank", at_most=T.orders(spark, d).count())


@register("spend_rank", q(_SPEND_SQL + """
SELECT customer_id, total_spend, n_orders,
  CAST(RANK() OVER (ORDER BY total_spend DESC) AS BIGINT) AS spend_rank FROM s"""))
def spend_rank(spark, d):
    return ranking.global_rank(_spend(spark, d), [("total_spend", "desc")], ["customer_id"],
                               method="rank", out="spend_rank", at_most=T.orders(spark, d).count())


@register("order_count_rank", q(_SPEND_SQL + """
SELECT customer_id, n_orders, CAST(RANK() OVER (ORDER BY n_orders DESC) AS BIGINT) AS count_rank FROM s"""))
def order_count_rank(spark, d):
    """A rank with many ties."""
    return ranking.global_rank(_spend(spark, d).select("customer_id", "n_orders"), [("n_orders", "desc")], ["customer_id"],
                               method="rank", out="count_rank", at_most=T.orders(spark, d).count())


@register("top_customers", q(_SPEND_SQL + """
SELECT customer_id, total_spend, n_orders FROM s ORDER BY total_spend DESC, customer_id LIMIT 10"""))
def top_customers(spark, d):
    return relational.top_groups(
        T.orders(spark, d), "customer_id",
        [money_sum("order_total").alias("total_spend"), F.count(F.lit(1)).alias("n_orders")],
        [F.desc("total_spend")], 10, ["customer_id"])


@register("status_share", q(f"""
SELECT status, COUNT(*) AS n_orders, {ratio('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 4, pct=True)} AS pct
FROM c_orders GROUP BY status"""))
def status_share(spark, d):
    return relational.share_of_total(T.orders(spark, d), "status", "n_orders", "pct", 4)


# --------------------------------------------------------------- time series

_MONTHLY_SQL = f""", m AS (SELECT {month('o.purchase_ts')} AS month,
  CAST(SUM(r.revenue) AS DECIMAL(18,2)) AS revenue, COUNT(*) AS n_orders
  FROM c_orders o JOIN c_revenue r ON o.order_id = r.order_id GROUP BY 1)"""

_CATEGORY_SQL = f""", g AS (SELECT {month('o.purchase_ts')} AS sales_month, p.category,
  CAST(SUM(i.price) AS DECIMAL(18,2)) AS total_sales
  FROM c_items i JOIN c_orders o ON i.order_id = o.order_id
  JOIN c_customers c ON o.customer_id = c.customer_id JOIN c_products p ON i.product_id = p.product_id
  GROUP BY 1, 2)"""


def monthly_revenue(spark, d) -> DataFrame:
    return sales.revenue_by_month(T.orders(spark, d), sales.order_revenue(T.items(spark, d)))


def monthly_category_sales(spark, d) -> DataFrame:
    det = sales.order_details(T.orders(spark, d), T.customers(spark, d), T.items(spark, d),
                              T.products(spark, d), line_total="price")
    return sales.monthly_category_totals(det).select("sales_month", "category", "total_sales")


@register("revenue_by_month", q(_MONTHLY_SQL + " SELECT month, revenue, n_orders FROM m"))
def revenue_by_month(spark, d):
    return monthly_revenue(spark, d)


@register("revenue_mom_delta", q(_MONTHLY_SQL + """
SELECT month, revenue, LAG(revenue) OVER (ORDER BY month) AS prev_revenue,
  CAST(revenue - LAG(revenue) OVER (ORDER BY month) AS DECIMAL(18,2)) AS revenue_delta FROM m"""))
def revenue_mom_delta(spark, d):
    m = monthly_revenue(spark, d).select("month", "revenue")
    out = timeseries.period_delta(m, "month", "revenue", prev="prev_revenue", delta="revenue_delta")
    return as_money(out, "revenue_delta")


@register("category_mom_delta", q(_CATEGORY_SQL + """
SELECT sales_month, category, total_sales,
  LAG(total_sales) OVER (PARTITION BY category ORDER BY sales_month) AS prev_sales,
  CAST(total_sales - LAG(total_sales) OVER (PARTITION BY category ORDER BY sales_month)
       AS DECIMAL(18,2)) AS sales_delta FROM g"""))
def category_mom_delta(spark, d):
    g = monthly_category_sales(spark, d)
    out = timeseries.period_delta(g, "sales_month", "total_sales", by="category",
                                  prev="prev_sales", delta="sales_delta")
    return as_money(out, "sales_delta")


@register("revenue_running", q(_MONTHLY_SQL + """
SELECT month, revenue, CAST(SUM(revenue) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING
  AND CURRENT ROW) AS DECIMAL(18,2)) AS running_revenue FROM m"""))
def revenue_running(spark, d):
    m = monthly_revenue(spark, d).select("month", "revenue")
    return as_money(timeseries.running_total(m, "month", "revenue", out="running_revenue"),
                    "running_revenue")


@register("revenue_ytd", q(_MONTHLY_SQL + """
SELECT month, revenue, CAST(SUM(revenue) OVER (PARTITION BY year(month) ORDER BY month
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS ytd_revenue FROM m"""))
def revenue_ytd(spark, d):
    m = monthly_revenue(spark, d).select("month", "revenue")
    return as_money(timeseries.running_total(m, "month", "revenue", reset="year", out="ytd_revenue"),
                    "ytd_revenue")


@register("category_running", q(_CATEGORY_SQL + """
SELECT sales_month, category, total_sales, CAST(SUM(total_sales) OVER (PARTITION BY category
  ORDER BY sales_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(18,2))
  AS running_sales FROM g"""))
def category_running(spark, d):
    g = monthly_category_sales(spark, d)
    return as_money(timeseries.running_total(g, "sales_month", "total_sales", by="category",
                                             out="running_sales"), "running_sales")


@register("revenue_rolling_3mo", q(_MONTHLY_SQL + """
SELECT month, revenue, CAST(SUM(revenue) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING
  AND CURRENT ROW) AS DECIMAL(18,2)) AS rolling_3mo FROM m"""))
def revenue_rolling_3mo(spark, d):
    m = monthly_revenue(spark, d).select("month", "revenue")
    return as_money(timeseries.rolling_sum(m, "month", "revenue", 3, "rows", out="rolling_3mo"),
                    "rolling_3mo")


@register("revenue_rolling_calendar", q(_MONTHLY_SQL + """
SELECT month, revenue, CAST(SUM(revenue) OVER (ORDER BY year(month) * 12 + month(month)
  RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS DECIMAL(18,2)) AS rolling_3mo FROM m"""))
def revenue_rolling_calendar(spark, d):
    m = monthly_revenue(spark, d).select("month", "revenue")
    return as_money(timeseries.rolling_sum(m, "month", "revenue", 3, "calendar", out="rolling_3mo"),
                    "rolling_3mo")


@register("orders_without_payments", q("""
SELECT order_id, customer_id, status, purchase_ts FROM c_orders o
WHERE NOT EXISTS (SELECT 1 FROM c_payments p WHERE p.order_id = o.order_id)"""))
def orders_without_payments(spark, d):
    o = T.orders(spark, d).select("order_id", "customer_id", "status", "purchase_ts")
    return relational.orders_without(o, T.payments(spark, d), "order_id")


# every line is a row of one series: no window holds it; line numbers repeat within an order, so the order goes on
_LINE_ORDER = ("shipped_ts", "order_id", "line_no", "product_id", "seller_id", "quantity", "paid")
_LINES_SQL = """
, l AS (SELECT order_id, line_no, return_flag, shipped_ts, product_id, seller_id, quantity, price AS paid,
  CASE WHEN line_no <> 3 THEN price END AS price FROM c_items)
"""


def _lines(spark, d) -> DataFrame:
    """Lines with a null price for every third line of an order."""
    return T.items(spark, d).select("order_id", "line_no", "return_flag", "shipped_ts", "product_id", "seller_id", "quantity",
                                    F.col("price").alias("paid"), F.when(F.col("line_no") != 3, F.col("price")).alias("price"))


@register("line_running_total", q(_LINES_SQL + """
SELECT order_id, line_no, SUM(price) OVER (ORDER BY shipped_ts NULLS FIRST, order_id, line_no,
  product_id, seller_id, quantity, paid ROWS UNBOUNDED PRECEDING) AS running_revenue FROM l"""))
def line_running_total(spark, d):
    """Running revenue line by line, over the whole table as one series."""
    out = series.running_sum(_lines(spark, d), "price", _LINE_ORDER, out="running_revenue")
    return out.select("order_id", "line_no", "running_revenue")


@register("line_rolling_sum", q(_LINES_SQL + """
SELECT order_id, line_no, return_flag, SUM(price) OVER (PARTITION BY return_flag ORDER BY shipped_ts NULLS FIRST, order_id, line_no,
  product_id, seller_id, quantity, paid ROWS BETWEEN 499 PRECEDING AND CURRENT ROW) AS revenue_500 FROM l"""))
def line_rolling_sum(spark, d):
    """Revenue of the last 500 lines with the same return flag (three flags: each a hot key)."""
    out = series.rolling_sum(_lines(spark, d), "price", _LINE_ORDER, 500, ["return_flag"], out="revenue_500")
    return out.select("order_id", "line_no", "return_flag", "revenue_500")
