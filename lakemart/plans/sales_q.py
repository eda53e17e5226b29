"""Sales, retention and KPI queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.operators import sales
from lakemart.plans import tables as T
from lakemart.plans.registry import register
from lakemart.plans.sqlfrag import avg_exact, month, q, ratio

# fixed report parameters
STATE = "NATION_7"
ORDERS_AS_OF = "2001-06-30 00:00:00"  # inside the data, so that later orders drop out
RECENT_DAYS, RECENT_K = 60, 10
PRICE_EDGES = (930, 970)


def _details(spark, d, with_payments=False):
    return sales.order_details(T.orders(spark, d), T.customers(spark, d), T.items(spark, d),
                               T.products(spark, d), T.payments(spark, d) if with_payments else None,
                               line_total="price")


_DETAILS_SQL = """, det AS (SELECT i.order_id, i.line_no, i.product_id, o.customer_id,
  CAST(i.quantity AS INTEGER) AS quantity, i.price AS unit_price, CAST(o.purchase_ts AS DATE) AS order_date,
  o.status AS order_status, c.customer_name, p.product_name, p.category, i.price AS total_item_price
  FROM c_items i JOIN c_orders o ON i.order_id = o.order_id
  JOIN c_customers c ON o.customer_id = c.customer_id JOIN c_products p ON i.product_id = p.product_id)"""


@register("order_revenue", q("SELECT order_id, revenue, n_items FROM c_revenue"))
def order_revenue(spark, d):
    return sales.order_revenue(T.items(spark, d))


@register("order_details", q(_DETAILS_SQL + """
, pay AS (SELECT order_id, CAST(SUM(payment_value) AS DECIMAL(18,2)) AS payment_amount,
  string_agg(DISTINCT payment_type, ',' ORDER BY payment_type) AS payment_method,
  MAX(CAST(payment_ts AS DATE)) AS payment_date FROM c_payments GROUP BY order_id)
SELECT det.*, pay.payment_amount, pay.payment_method, pay.payment_date
FROM det LEFT JOIN pay ON det.order_id = pay.order_id"""))
def order_details(spark, d):
    return _details(spark, d, with_payments=True)


@register("order_lines", q("""
SELECT i.order_id, i.line_no, p.product_name, i.quantity, p.price AS unit_price, i.price AS line_total
FROM c_items i JOIN c_orders o ON i.order_id = o.order_id JOIN c_products p ON i.product_id = p.product_id"""))
def order_lines(spark, d):
    return sales.order_lines(T.orders(spark, d), T.items(spark, d), T.products(spark, d))


@register("order_item_context", q("""
SELECT i.order_id, i.line_no, c.state, i.product_id, p.category, i.price, i.freight
FROM c_items i JOIN c_orders o ON i.order_id = o.order_id
LEFT JOIN c_customers c ON o.customer_id = c.customer_id LEFT JOIN c_products p ON i.product_id = p.product_id"""))
def order_item_context(spark, d):
    return sales.order_item_context(T.orders(spark, d), T.customers(spark, d), T.items(spark, d),
                                    T.products(spark, d))


@register("order_totals", q(_DETAILS_SQL + """
SELECT customer_id, customer_name, order_id, order_date,
  CAST(SUM(total_item_price) AS DECIMAL(18,2)) AS order_total, CAST(SUM(quantity) AS BIGINT) AS n_units
FROM det GROUP BY customer_id, customer_name, order_id, order_date"""))
def order_totals(spark, d):
    return sales.order_totals(_details(spark, d))


@register("customer_spend", q("""
SELECT customer_id, CAST(SUM(order_total) AS DECIMAL(18,2)) AS total_spend, COUNT(*) AS n_orders
FROM c_orders GROUP BY customer_id"""))
def customer_spend(spark, d):
    return sales.customer_spend(T.orders(spark, d))


@register("orders_in_state", q(f"""
SELECT o.order_id, o.customer_id, c.state, o.status, o.purchase_ts
FROM c_orders o JOIN c_customers c ON o.customer_id = c.customer_id WHERE c.state = '{STATE}'"""))
def orders_in_state(spark, d):
    return sales.orders_in_state(T.orders(spark, d), T.customers(spark, d), STATE)


@register("payment_mix", q("""
SELECT payment_type, COUNT(*) AS n_payments, CAST(SUM(payment_value) AS DECIMAL(18,2)) AS total_value
FROM c_payments GROUP BY payment_type"""))
def payment_mix(spark, d):
    return sales.payment_mix(T.payments(spark, d))


@register("delivery_status", q("""
, s AS (SELECT order_id, MAX(shipped_ts) AS delivered_ts FROM c_items GROUP BY order_id)
SELECT o.order_id, s.delivered_ts, o.purchase_ts + INTERVAL 30 DAY AS estimated_ts,
  CASE WHEN s.delivered_ts IS NULL THEN 'Pending'
       WHEN s.delivered_ts <= o.purchase_ts + INTERVAL 30 DAY THEN 'On-time' ELSE 'Late' END AS delivery_status
FROM c_orders o LEFT JOIN s ON o.order_id = s.order_id"""))
def delivery_status(spark, d):
    return sales.delivery_status(T.orders(spark, d), T.items(spark, d), 30)


@register("payment_bucket", q("""
SELECT payment_id, order_id, payment_value,
  CASE WHEN COALESCE(payment_value, 0) = 0 THEN 'Free' WHEN COALESCE(payment_value, 0) < 50 THEN 'Low'
       ELSE 'High' END AS payment_bucket FROM c_payments"""))
def payment_bucket(spark, d):
    return sales.payment_bucket(T.payments(spark, d), 50)


@register("price_band", q(f"""
SELECT product_id, price, CASE WHEN price > {PRICE_EDGES[1]} THEN 'High'
  WHEN price > {PRICE_EDGES[0]} THEN 'Medium' ELSE 'Low' END AS price_band FROM c_products"""))
def price_band(spark, d):
    return sales.price_band(T.products(spark, d), PRICE_EDGES)


@register("above_average_parts", q("""
SELECT product_id, product_name, price FROM c_products
WHERE price > (SELECT AVG(price) FROM c_products)"""))
def above_average_parts(spark, d):
    return sales.above_average(T.products(spark, d).select("product_id", "product_name", "price"), "price")


@register("big_spenders", q("""
SELECT o.customer_id, CAST(SUM(r.revenue) AS DECIMAL(18,2)) AS total_revenue
FROM c_orders o JOIN c_revenue r ON o.order_id = r.order_id GROUP BY o.customer_id
HAVING SUM(r.revenue) > (SELECT AVG(revenue) FROM c_revenue)"""))
def big_spenders(spark, d):
    return sales.big_spenders(T.orders(spark, d), sales.order_revenue(T.items(spark, d)))


@register("revenue_by_category", q("""
SELECT COALESCE(p.category, 'unknown') AS category, CAST(SUM(i.price + i.freight) AS DECIMAL(18,2)) AS revenue,
  COUNT(*) AS n_items, COUNT(DISTINCT i.order_id) AS n_orders
FROM c_items i LEFT JOIN c_products p ON i.product_id = p.product_id GROUP BY 1"""))
def revenue_by_category(spark, d):
    return sales.revenue_by_category(T.items(spark, d), T.products(spark, d))


@register("revenue_by_state", q("""
SELECT c.state, CAST(SUM(r.revenue) AS DECIMAL(18,2)) AS revenue, COUNT(*) AS n_orders
FROM c_orders o JOIN c_revenue r ON o.order_id = r.order_id
JOIN c_customers c ON o.customer_id = c.customer_id GROUP BY c.state"""))
def revenue_by_state(spark, d):
    return sales.revenue_by_state(T.orders(spark, d), sales.order_revenue(T.items(spark, d)),
                                  T.customers(spark, d))


@register("monthly_sales_by_category", q(_DETAILS_SQL + f"""
SELECT {month('order_date')} AS sales_month, category,
  CAST(SUM(total_item_price) AS DECIMAL(18,2)) AS total_sales,
  COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers
FROM det GROUP BY 1, 2"""))
def monthly_sales_by_category(spark, d):
    return sales.monthly_sales_by_category(_details(spark, d), lines=T.items(spark, d).count())


@register("cohorts", q(f"""
SELECT customer_id, MIN({month('purchase_ts')}) AS cohort_month FROM c_orders GROUP BY customer_id"""))
def cohorts(spark, d):
    return sales.cohorts(T.orders(spark, d))


@register("retained_customers", q(f"""
SELECT customer_id, MIN({month('purchase_ts')}) AS cohort_month, MAX({month('purchase_ts')}) AS last_month
FROM c_orders GROUP BY customer_id HAVING MAX({month('purchase_ts')}) > MIN({month('purchase_ts')})"""))
def retained_customers(spark, d):
    return sales.retained_customers(T.orders(spark, d))


@register("consecutive_month_customers", q(f"""
, cm AS (SELECT DISTINCT customer_id, {month('purchase_ts')} AS m FROM c_orders)
SELECT DISTINCT a.customer_id FROM cm a JOIN cm b
  ON a.customer_id = b.customer_id AND b.m = a.m + INTERVAL 1 MONTH"""))
def consecutive_month_customers(spark, d):
    return sales.consecutive_month_customers(T.orders(spark, d))


@register("repeat_rate", q(f"""
, per AS (SELECT customer_id, COUNT(*) AS n FROM c_orders GROUP BY customer_id)
SELECT COUNT(*) AS n_customers, CAST(SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_repeat,
  {ratio('SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END)', 'COUNT(*)', 4)} AS repeat_rate FROM per"""))
def repeat_rate(spark, d):
    return sales.repeat_rate(T.orders(spark, d))


@register("kpi_snapshot", q(f"""
, dl AS (SELECT DISTINCT order_id FROM c_items),
os AS (SELECT COUNT(DISTINCT o.order_id) AS n_orders,
  {ratio('COUNT(dl.order_id)', 'COUNT(*)', 2)} AS pct_delivered,
  MIN(o.purchase_ts) AS first_order, MAX(o.purchase_ts) AS last_order
  FROM c_orders o LEFT JOIN dl ON o.order_id = dl.order_id)
SELECT (SELECT COUNT(DISTINCT customer_id) FROM c_customers) AS n_customers, n_orders,
  (SELECT COUNT(*) FROM c_items) AS n_items, pct_delivered,
  (SELECT {avg_exact('revenue', 2, 2)} FROM c_revenue) AS aov, first_order, last_order FROM os"""))
def kpi_snapshot(spark, d):
    return sales.kpi_snapshot(T.orders(spark, d), T.customers(spark, d), sales.order_revenue(T.items(spark, d)))


@register("recent_orders", q(f"""
, a AS (SELECT TIMESTAMP '{ORDERS_AS_OF}' AS as_of)
SELECT order_id, customer_id, status, purchase_ts,
  CAST(datediff('day', purchase_ts, as_of) AS BIGINT) AS age_days
FROM c_orders, a
WHERE purchase_ts >= as_of - INTERVAL {RECENT_DAYS} DAY AND purchase_ts <= as_of
ORDER BY purchase_ts DESC, order_id LIMIT {RECENT_K}"""))
def recent_orders(spark, d):
    o = T.orders(spark, d)
    return sales.recent_orders(o, RECENT_DAYS, F.lit(ORDERS_AS_OF).cast("timestamp_ntz"), RECENT_K)


@register("status_counts", q("SELECT status, COUNT(*) AS n_orders FROM c_orders GROUP BY status"))
def status_counts(spark, d):
    return sales.status_counts(T.orders(spark, d))


@register("undelivered_status_counts", q("""
SELECT status, COUNT(*) AS n_orders FROM c_orders WHERE status IN ('O', 'P') GROUP BY status"""))
def undelivered_status_counts(spark, d):
    return sales.status_counts(T.orders(spark, d), ["O", "P"])


@register("revenue_by_state_items", q("""
SELECT c.state, CAST(SUM(i.price + i.freight) AS DECIMAL(18,2)) AS revenue, COUNT(DISTINCT i.order_id) AS n_orders
FROM c_items i JOIN c_orders o ON i.order_id = o.order_id
JOIN c_customers c ON o.customer_id = c.customer_id GROUP BY c.state"""))
def revenue_by_state_items(spark, d):
    return sales.revenue_by_state_items(T.orders(spark, d), T.items(spark, d), T.customers(spark, d))


NAME_PREFIX = "red"


@register("name_prefix", q(f"""
SELECT product_id, product_name, category FROM c_products WHERE product_name LIKE '{NAME_PREFIX}%'"""))
def name_prefix(spark, d):
    from lakemart.operators.relational import with_prefix
    return with_prefix(T.products(spark, d).select("product_id", "product_name", "category"),
                       "product_name", NAME_PREFIX)


@register("order_sample", None)
def order_sample(spark, d):
    """Any ten joined order lines (LIMIT without ORDER BY: a sample, rows-only check)."""
    from lakemart.sources.files import preview
    return preview(sales.order_item_context(T.orders(spark, d), T.customers(spark, d), T.items(spark, d),
                                            T.products(spark, d)), 10)


@register("order_sample_found", q("""
SELECT LEAST(COUNT(*), 10) AS n_rows, LEAST(COUNT(*), 10) AS n_found
FROM c_items i JOIN c_orders o ON i.order_id = o.order_id"""))
def order_sample_found(spark, d):
    """The sample's size, and how many of its keys the full join holds."""
    sample = order_sample(spark, d).select("order_id", "line_no").withColumn("_s", F.lit(1))
    full = T.items(spark, d).join(T.orders(spark, d).select("order_id"), "order_id", "left_semi").select("order_id", "line_no").distinct()
    return sample.join(full.withColumn("_f", F.lit(1)), ["order_id", "line_no"], "left").agg(
        F.count("_s").alias("n_rows"), F.count("_f").alias("n_found"))


@register("top_customers_by_orders", q("""
SELECT customer_id, COUNT(order_id) AS total_orders FROM c_orders GROUP BY customer_id
ORDER BY total_orders DESC, customer_id LIMIT 10"""))
def top_customers_by_orders(spark, d):
    from lakemart.operators.relational import top_groups
    return top_groups(T.orders(spark, d), "customer_id", [F.count("order_id").alias("total_orders")],
                      [F.desc("total_orders")], 10, ["customer_id"])


@register("top_items_by_price", q("""
SELECT order_id, line_no, product_id, seller_id, price, freight FROM c_items
ORDER BY price DESC, order_id, line_no, product_id, seller_id LIMIT 10"""))
def top_items_by_price(spark, d):
    from lakemart.operators.relational import top_rows
    i = T.items(spark, d).select("order_id", "line_no", "product_id", "seller_id", "price", "freight")
    return top_rows(i, [F.desc("price")], 10, ["order_id", "line_no", "product_id", "seller_id"])


@register("top_products_by_revenue", q("""
SELECT product_id, CAST(SUM(price + freight) AS DECIMAL(18,2)) AS revenue, COUNT(*) AS n_items FROM c_items
GROUP BY product_id ORDER BY revenue DESC, product_id LIMIT 5"""))
def top_products_by_revenue(spark, d):
    from lakemart.functions.columns import money_sum
    from lakemart.operators.relational import top_groups
    return top_groups(T.items(spark, d), "product_id",
                      [money_sum(F.col("price") + F.col("freight")).alias("revenue"), F.count(F.lit(1)).alias("n_items")],
                      [F.desc("revenue")], 5, ["product_id"])


FILTER_CATEGORY, FILTER_MIN_PRICE = "ECONOMY", 950


@register("filtered_products", q(f"""
SELECT product_id, product_name, category, price FROM c_products
WHERE category = '{FILTER_CATEGORY}' AND price > {FILTER_MIN_PRICE}"""))
def filtered_products(spark, d):
    p = T.products(spark, d, price_above=FILTER_MIN_PRICE).select("product_id", "product_name", "category", "price")
    return p.where((F.col("category") == FILTER_CATEGORY) & (F.col("price") > FILTER_MIN_PRICE))


@register("products_per_category", q("""
SELECT category, COUNT(*) AS n_products FROM c_products GROUP BY category"""))
def products_per_category(spark, d):
    return T.products(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n_products"))


@register("orders_with_customer_names", q("""
SELECT o.order_id, c.customer_name, o.purchase_ts, o.status
FROM c_orders o JOIN c_customers c ON o.customer_id = c.customer_id"""))
def orders_with_customer_names(spark, d):
    return (T.orders(spark, d).join(T.customers(spark, d), "customer_id")
            .select("order_id", "customer_name", "purchase_ts", "status"))
