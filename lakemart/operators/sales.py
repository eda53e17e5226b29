"""Order, revenue, retention and KPI operators (silver -> gold).

Canonical inputs (the ``plans`` layer maps source tables onto them):

* orders:    order_id, customer_id, status, purchase_ts, order_total
* items:     order_id, line_no, product_id, seller_id, quantity, price, freight, shipped_ts
* customers: customer_id, customer_name, state, segment
* products:  product_id, product_name, category, price
* payments:  payment_id, order_id, payment_type, payment_value, payment_ts

Money columns are ``DECIMAL(18,2)``. Joins to growing tables are left to
the planner (AQE broadcasts a side only after measuring it); payments are
aggregated to order grain before they meet item-grain rows, so an order's
payment is never counted once per item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import (
    MONEY, avg_exact, band, count_when, money, money_sum, month_start, ratio, scalar_lit, within_days,
)
from lakemart.operators.relational import next_period_keys, task_count


def order_revenue(items: DataFrame) -> DataFrame:
    """Revenue per order: ``SUM(price + freight)`` and item count."""
    return items.groupBy("order_id").agg(
        money_sum(F.col("price") + F.col("freight")).alias("revenue"),
        F.count(F.lit(1)).alias("n_items"))


def revenue_by_month(orders: DataFrame, revenue: DataFrame) -> DataFrame:
    """Order revenue summed per purchase month (DATE of the 1st)."""
    o = orders.select("order_id", month_start("purchase_ts").alias("month"))
    return (o.join(revenue, "order_id").groupBy("month")
            .agg(money_sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n_orders")))


def order_payments(payments: DataFrame) -> DataFrame:
    """Payments at order grain: total value and the types used (sorted, joined)."""
    return payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("payment_amount"),
        F.array_join(F.sort_array(F.collect_set("payment_type")), ",").alias("payment_method"),
        F.max(F.col("payment_ts").cast("date")).alias("payment_date"))


def order_details(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame,
                  payments: DataFrame | None = None, payment_join: str = "left",
                  line_total: str | None = None) -> DataFrame:
    """Denormalised item-grain fact: orders ⋈ customers ⋈ items ⋈ products ⟕ payments.

    ``total_item_price`` is ``quantity × price``, or the item column
    ``line_total`` when the source already carries the line amount.
    Inner joins drop orders without items (as written); ``payment_join``
    selects a left (keep unpaid) or inner payment join. Payments are summed
    per order first, so an order paid once is not counted once per item.
    Many items (they are counted) meet their orders in as many tasks as
    ``task_count`` says; groupings that include the order stay there.
    """
    o = orders.select("order_id", "customer_id", F.col("purchase_ts").cast("date").alias("order_date"),
                      F.col("status").alias("order_status"))
    c = customers.select("customer_id", "customer_name")
    total = F.col(line_total) if line_total else F.col("quantity") * F.col("price")
    i = items.select("order_id", "line_no", "product_id", F.col("quantity").cast("int").alias("quantity"),
                     F.col("price").alias("unit_price"), money(total).alias("total_item_price"))
    p = products.select("product_id", "product_name", "category")
    # customers join at order grain, before the more numerous lines
    placed = o.join(c, "customer_id")
    names = i.join(placed, "order_id").join(p, "product_id").columns
    tasks = task_count(items.count())
    if tasks:
        d = i.join(p, "product_id").repartition(tasks, "order_id").join(placed, "order_id").select(*names)
    else:
        d = i.join(placed, "order_id").join(p, "product_id")
    if payments is not None:
        d = d.join(order_payments(payments), "order_id", payment_join)
    return d


def order_lines(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Line view: order, product, quantity, unit price and line total."""
    i = items.select("order_id", "line_no", "product_id", "quantity", "price")
    p = products.select("product_id", "product_name", F.col("price").alias("unit_price"))
    return (i.join(orders.select("order_id"), "order_id").join(p, "product_id")
            .select("order_id", "line_no", "product_name", F.col("quantity").cast("bigint").alias("quantity"),
                    "unit_price", F.col("price").alias("line_total")))


def order_item_context(orders: DataFrame, customers: DataFrame, items: DataFrame,
                       products: DataFrame) -> DataFrame:
    """Order, customer state, product, category (left: unknown products kept), price, freight."""
    o = orders.select("order_id", "customer_id")
    c = customers.select("customer_id", "state")
    p = products.select("product_id", "category")
    i = items.select("order_id", "line_no", "product_id", "price", "freight")
    return (i.join(o.join(c, "customer_id", "left"), "order_id").join(p, "product_id", "left")
            .select("order_id", "line_no", "state", "product_id", "category", "price", "freight"))


def order_totals(details: DataFrame) -> DataFrame:
    """Totals per customer, order and date from the detail fact (the name is
    carried in the grouping as it is shown; it depends on the customer id)."""
    return details.groupBy("customer_id", "customer_name", "order_id", "order_date").agg(
        money_sum("total_item_price").alias("order_total"),
        F.sum("quantity").cast("bigint").alias("n_units"))


def payment_mix(payments: DataFrame) -> DataFrame:
    """Count and value per payment type."""
    return payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("n_payments"), money_sum("payment_value").alias("total_value"))


def delivery_status(orders: DataFrame, items: DataFrame, sla_days: int = 30) -> DataFrame:
    """SLA label per order: Pending (not delivered), On-time, Late.

    Delivered = last item shipment; estimate = purchase + ``sla_days``.
    """
    shipped = items.groupBy("order_id").agg(F.max("shipped_ts").alias("delivered_ts"))
    o = orders.select("order_id", "purchase_ts").join(shipped, "order_id", "left")
    est = F.col("purchase_ts") + F.make_dt_interval(F.lit(sla_days))
    label = (F.when(F.col("delivered_ts").isNull(), "Pending")
             .when(F.col("delivered_ts") <= F.col("estimated_ts"), "On-time").otherwise("Late"))
    return (o.withColumn("estimated_ts", est).withColumn("delivery_status", label)
            .select("order_id", "delivered_ts", "estimated_ts", "delivery_status"))


def payment_bucket(payments: DataFrame, low_below: float = 50) -> DataFrame:
    """Free (0 or missing) / Low (< ``low_below``) / High per payment."""
    v = F.coalesce(F.col("payment_value"), F.lit(0).cast(MONEY))
    b = F.when(v == 0, "Free").when(v < F.lit(low_below), "Low").otherwise("High")
    return payments.select("payment_id", "order_id", "payment_value", b.alias("payment_bucket"))


def price_band(products: DataFrame, edges: Sequence[float] = (50, 100),
               labels: Sequence[str] = ("Low", "Medium", "High")) -> DataFrame:
    """Low / Medium / High by price thresholds (string prices cast first)."""
    return products.select("product_id", "price", band(F.col("price"), edges, labels).alias("price_band"))


def above_average(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` exceeds the overall average, which is resolved once into a literal."""
    return df.where(F.col(col) > scalar_lit(df.select(F.avg(F.col(col)))))


def big_spenders(orders: DataFrame, revenue: DataFrame) -> DataFrame:
    """Customers whose total revenue exceeds the average *order* revenue (as written)."""
    # all revenue is kept by the join, so the average reads the same shuffled sums per order; null totals fail the test
    known = orders.select("order_id", "customer_id", F.lit(True).alias("_known"))
    overall = revenue.select(F.struct(F.sum("revenue").alias("s"), F.count("revenue").alias("n"))).scalar()
    per = revenue.select("order_id", "revenue").join(known, "order_id", "left").groupBy("customer_id").agg(
        money_sum(F.when(F.col("_known"), F.col("revenue"))).alias("total_revenue"))
    return (per.withColumn("_all", overall).where(F.col("total_revenue") * F.col("_all.n") > F.col("_all.s"))
            .select("customer_id", "total_revenue"))


def revenue_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category; items with no product match land in 'unknown'."""
    p = products.select("product_id", "category")
    return (items.select("order_id", "product_id", "price", "freight").join(p, "product_id", "left")
            .withColumn("category", F.coalesce(F.col("category"), F.lit("unknown")))
            .groupBy("category").agg(
                money_sum(F.col("price") + F.col("freight")).alias("revenue"),
                F.count(F.lit(1)).alias("n_items"),
                F.count_distinct("order_id").alias("n_orders")))


def revenue_by_state(orders: DataFrame, revenue: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue and order count per customer state, via order revenue."""
    return (orders.select("order_id", "customer_id").join(revenue, "order_id")
            .join(customers.select("customer_id", "state"), "customer_id")
            .groupBy("state").agg(money_sum("revenue").alias("revenue"),
                                  F.count(F.lit(1)).alias("n_orders")))


def revenue_by_state_items(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per customer state summed straight from item rows."""
    placed = orders.select("order_id", "customer_id").join(customers.select("customer_id", "state"), "customer_id")
    return (items.select("order_id", "price", "freight").join(placed.select("order_id", "state"), "order_id")
            .groupBy("state").agg(money_sum(F.col("price") + F.col("freight")).alias("revenue"),
                                  F.count_distinct("order_id").alias("n_orders")))


def monthly_sales_by_category(details: DataFrame, approx: bool = False, rsd: float = 0.02,
                              lines: int | None = None) -> DataFrame:
    """Gold: sales, distinct orders and distinct customers per month and category.

    Exact counts come from three nested groupings (order, customer, month)
    that combine map-side, so no row is expanded; an order has one customer.
    ``lines``, about the number of rows, lets ``task_count`` deal the orders
    to customers in tasks of bounded memory; without it Spark decides.
    ``approx=True`` counts with HyperLogLog++ sketches in one grouping.
    """
    d = details.withColumn("sales_month", month_start("order_date"))
    if approx:
        return d.groupBy("sales_month", "category").agg(
            money_sum("total_item_price").alias("total_sales"),
            F.approx_count_distinct("order_id", rsd).alias("total_orders"),
            F.approx_count_distinct("customer_id", rsd).alias("unique_customers"))
    per_order = d.groupBy("sales_month", "category", "customer_id", "order_id").agg(
        money_sum("total_item_price").alias("_sales"))
    tasks = task_count(lines or 0)
    if tasks:
        per_order = per_order.repartition(tasks, "sales_month", "category", "customer_id")
    per_customer = per_order.groupBy("sales_month", "category", "customer_id").agg(
        F.sum("_sales").alias("_sales"), F.count("order_id").alias("_orders"))
    return per_customer.groupBy("sales_month", "category").agg(
        money_sum("_sales").alias("total_sales"), F.sum("_orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"))


def monthly_category_totals(details: DataFrame) -> DataFrame:
    """Sales per month and category alone: one grouping, combined map-side."""
    return details.groupBy(month_start("order_date").alias("sales_month"), "category").agg(
        money_sum("total_item_price").alias("total_sales"))


def customer_spend(orders: DataFrame, amount: str = "order_total") -> DataFrame:
    """Total spend and order count per customer, summed at order grain."""
    return orders.groupBy("customer_id").agg(money_sum(amount).alias("total_spend"),
                                             F.count(F.lit(1)).alias("n_orders"))


def cohorts(orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """First purchase month per customer."""
    return orders.groupBy(customer_key).agg(F.min(month_start("purchase_ts")).alias("cohort_month"))


def retained_customers(orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Customers with an order after their first month: one aggregate, no self-join."""
    m = month_start("purchase_ts")
    return (orders.groupBy(customer_key).agg(F.min(m).alias("cohort_month"), F.max(m).alias("last_month"))
            .where(F.col("last_month") > F.col("cohort_month")))


def consecutive_month_customers(orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Customers with orders in some month M and in M+1."""
    o = orders.select(customer_key, month_start("purchase_ts").alias("month"))
    return next_period_keys(o, customer_key, "month").select(customer_key).distinct()


def repeat_rate(orders: DataFrame, customer_key: str = "customer_id") -> DataFrame:
    """Share of customers with more than one order."""
    per = orders.groupBy(customer_key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_customers"),
                   count_when(F.col("n") > 1).alias("n_repeat")) \
        .withColumn("repeat_rate", ratio("n_repeat", "n_customers", 4))


def kpi_snapshot(orders: DataFrame, customers: DataFrame, revenue: DataFrame) -> DataFrame:
    """One row: delivered rate, average order value, entity counts, order window.

    ``revenue`` (one row per order, see ``order_revenue``) already holds the
    delivered orders, the item count and the order values, so the items are
    read once. ``order_id`` is unique in ``orders``.
    """
    o = orders.select("order_id", "purchase_ts", F.lit(1).alias("_o"))
    r = revenue.select("order_id", "revenue", "n_items", F.lit(1).alias("_r"))
    j = o.join(r, "order_id", "full_outer")
    stats = j.agg(F.count("_o").alias("n_orders"), F.coalesce(F.sum("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
                  ratio(F.count(F.when(F.col("_o").isNotNull(), F.col("_r"))), F.count("_o"), 2).alias("pct_delivered"),
                  avg_exact("revenue", 2, 2).alias("aov"),
                  F.min("purchase_ts").alias("first_order"), F.max("purchase_ts").alias("last_order"))
    return stats.select(customers.select(F.count_distinct("customer_id")).scalar().alias("n_customers"),
                        "n_orders", "n_items", "pct_delivered", "aov", "first_order", "last_order")


def recent_orders(orders: DataFrame, days: int, as_of: Column, k: int) -> DataFrame:
    """Newest ``k`` orders within ``days`` of ``as_of``, with their age in days."""
    return (orders.where(within_days("purchase_ts", days, as_of))
            .select("order_id", "customer_id", "status", "purchase_ts",
                    F.datediff(as_of, F.col("purchase_ts")).cast("bigint").alias("age_days"))
            .orderBy(F.desc("purchase_ts"), F.asc("order_id")).limit(k))


def orders_in_state(orders: DataFrame, customers: DataFrame, state: str) -> DataFrame:
    """Orders of customers in one state (filter pushed to the customer scan)."""
    c = customers.where(F.col("state") == state).select("customer_id", "state")
    return orders.join(c, "customer_id").select("order_id", "customer_id", "state", "status", "purchase_ts")


def status_counts(orders: DataFrame, undelivered: Sequence[str] | None = None) -> DataFrame:
    """Orders per status; with ``undelivered`` only those statuses."""
    o = orders if undelivered is None else orders.where(F.col("status").isin(list(undelivered)))
    return o.groupBy("status").agg(F.count(F.lit(1)).alias("n_orders"))
