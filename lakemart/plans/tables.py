"""Driver tables and their mapping onto the canonical model.

| canonical | driver table | mapping |
| --- | --- | --- |
| orders    | orders   | order_id=o_orderkey, customer_id=o_custkey, status=o_orderstatus, purchase_ts=o_orderdate, order_total=o_totalprice |
| items     | lineitem | product=l_partkey, seller=l_suppkey, price=l_extendedprice, freight=price·l_tax, shipped_ts=l_shipdate |
| customers | customer ⋈ nation | state=n_name, segment=c_mktsegment, balance=c_acctbal |
| products  | part     | category=p_type, price=p_retailprice |
| payments  | events   | payment_type=event_type, payment_value=value, payment_ts=ts; event_id doubles as the order reference |
| taps      | events   | station=event_type, passengers=value, tap_ts=ts |
| leads     | orders ⋈ customer | region=c_mktsegment, status converted/open/pending from o_orderstatus F/O/P, deal_value=o_totalprice, source=o_orderpriority |

Reads name only the columns each mapping needs, so Catalyst prunes the
parquet scan to them (``ReadSchema``) and pushes filters into it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.columns import MONEY

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("purchase_ts"),
        F.col("o_totalprice").cast(MONEY).alias("order_total"),
        F.col("o_orderpriority").alias("priority"))


def items(spark, d) -> DataFrame:
    price = F.col("l_extendedprice").cast(MONEY)
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"), price.alias("price"),
        (price * F.col("l_tax").cast(MONEY)).cast(MONEY).alias("freight"),
        F.col("l_discount").cast(MONEY).alias("discount"), F.col("l_tax").cast(MONEY).alias("tax"),
        F.col("l_shipdate").alias("shipped_ts"), F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"))


def nation(spark, d) -> DataFrame:
    # TPC-H fixes nation at 25 rows at every scale: a proven broadcast bound.
    return F.broadcast(table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey"))


def customers(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    return c.join(nation(spark, d), c["c_nationkey"] == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("nation_id"), F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").cast(MONEY).alias("balance"))


def products(spark, d, price_above: float | None = None) -> DataFrame:
    """``price_above``: rows certainly not above it are left out by a filter on the raw
    column, which reaches the scan; the caller tests the exact price."""
    p = table(spark, d, "part")
    if price_above is not None:
        p = p.where(F.col("p_retailprice") > price_above - 0.01)
    return p.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        F.col("p_size").alias("size"), F.col("p_retailprice").cast(MONEY).alias("price"))


def payments(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id").alias("payment_id"), F.col("event_id").alias("order_id"),
        F.col("event_type").alias("payment_type"), F.col("value").cast(MONEY).alias("payment_value"),
        F.col("ts").alias("payment_ts"))


def taps(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id"), F.col("event_type").alias("station_name"),
        F.col("value").cast(MONEY).alias("passengers"), F.col("ts").alias("tap_ts"),
        F.col("user_id"))


def leads(spark, d, value_above: float | None = None) -> DataFrame:
    """``value_above``: as ``price_above`` of ``products``."""
    o = table(spark, d, "orders")
    if value_above is not None:
        o = o.where(F.col("o_totalprice") > value_above - 0.01)
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    status = (F.when(F.col("o_orderstatus") == "F", "converted")
              .when(F.col("o_orderstatus") == "O", "open").otherwise("pending"))
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        F.col("o_orderkey").alias("lead_id"), F.col("c_mktsegment").alias("region"),
        status.alias("status"), F.col("o_orderdate").cast("date").alias("created_date"),
        F.col("o_orderdate").alias("created_ts"),
        F.col("o_totalprice").cast(MONEY).alias("deal_value"), F.col("o_orderpriority").alias("source"))


# SQL mirror of the mapping for the DuckDB oracle (same names, same types).
SQL_CTES = """
c_orders AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
  o_orderdate AS purchase_ts, CAST(o_totalprice AS DECIMAL(18,2)) AS order_total,
  o_orderpriority AS priority FROM orders),
c_items AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
  l_suppkey AS seller_id, CAST(l_quantity AS BIGINT) AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS freight,
  CAST(l_discount AS DECIMAL(18,2)) AS discount, CAST(l_tax AS DECIMAL(18,2)) AS tax,
  l_shipdate AS shipped_ts, l_returnflag AS return_flag, l_linestatus AS line_status FROM lineitem),
c_customers AS (SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
  n_name AS state, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
c_products AS (SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand,
  p_type AS category, p_size AS size, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part),
c_payments AS (SELECT event_id AS payment_id, event_id AS order_id, event_type AS payment_type,
  CAST(value AS DECIMAL(18,2)) AS payment_value, ts AS payment_ts FROM events),
c_taps AS (SELECT event_id, event_type AS station_name, CAST(value AS DECIMAL(18,2)) AS passengers,
  ts AS tap_ts, user_id FROM events),
c_leads AS (SELECT o_orderkey AS lead_id, c_mktsegment AS region,
  CASE WHEN o_orderstatus = 'F' THEN 'converted' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'pending' END AS status,
  CAST(o_orderdate AS DATE) AS created_date, o_orderdate AS created_ts, CAST(o_totalprice AS DECIMAL(18,2)) AS deal_value,
  o_orderpriority AS source FROM orders JOIN customer ON o_custkey = c_custkey),
c_revenue AS (SELECT order_id, CAST(SUM(price + freight) AS DECIMAL(18,2)) AS revenue,
  COUNT(*) AS n_items FROM c_items GROUP BY order_id)
"""
