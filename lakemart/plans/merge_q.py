"""SCD, upsert and star-schema queries.

The SCD dimension is the customer table: CustomerID, Name, Region (nation
name), loaded on 2023-01-01. The change batch is derived from the same
table: customers in arrears (negative balance) move to the next nation on
2023-06-15, and high-balance household customers arrive as new keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions.columns import MONEY
from lakemart.operators import merge, star
from lakemart.operators.ranking import assign_keys
from lakemart.plans import tables as T
from lakemart.plans.registry import register
from lakemart.plans.sqlfrag import q
from lakemart.session import scratch_path
from lakemart.sources import files

# fixed values of the scenario
LOAD_DATE, CHANGE_DATE, CLOSE_DATE = "2023-01-01", "2023-06-15", "2023-06-14"
NEW_KEY_OFFSET = 1_000_000_000
UNKNOWN_PRODUCT_OFFSET = 2_000_000_000
KEYS = ["CustomerID"]


def scd_source(spark, d):
    return T.customers(spark, d).select(
        F.col("customer_id").alias("CustomerID"), F.col("customer_name").alias("Name"),
        F.col("state").alias("Region"), F.lit(LOAD_DATE).cast("date").alias("EffectiveDate"))


def scd_changes(spark, d):
    c = T.customers(spark, d)
    n = T.nation(spark, d)
    movers = (c.where(F.col("balance") < 0)
              .join(n, n["n_nationkey"] == (c["nation_id"] + 1) % 25)
              .select(F.col("customer_id").alias("CustomerID"), F.col("customer_name").alias("Name"),
                      F.col("n_name").alias("Region")))
    arrivals = (c.where((F.col("segment") == "HOUSEHOLD") & (F.col("balance") > 9000))
                .select((F.col("customer_id") + NEW_KEY_OFFSET).alias("CustomerID"),
                        F.col("customer_name").alias("Name"), F.col("state").alias("Region")))
    return movers.unionByName(arrivals).withColumn("EffectiveDate", F.lit(CHANGE_DATE).cast("date"))


_SCD_SQL = f"""
, src AS (SELECT customer_id AS CustomerID, customer_name AS Name, state AS Region,
  DATE '{LOAD_DATE}' AS EffectiveDate FROM c_customers),
chg AS (SELECT c.customer_id AS CustomerID, c.customer_name AS Name, n.n_name AS Region,
  DATE '{CHANGE_DATE}' AS EffectiveDate FROM c_customers c JOIN nation n ON n.n_nationkey = (c.nation_id + 1) % 25
  WHERE c.balance < 0
  UNION ALL SELECT customer_id + {NEW_KEY_OFFSET}, customer_name, state, DATE '{CHANGE_DATE}' FROM c_customers
  WHERE segment = 'HOUSEHOLD' AND balance > 9000),
t1 AS (SELECT CustomerID, Name, Region, EffectiveDate AS LastUpdatedDate FROM src),
t2 AS (SELECT ROW_NUMBER() OVER (ORDER BY CustomerID) AS CustomerSK, CustomerID, Name, Region,
  EffectiveDate AS StartDate, DATE '9999-12-31' AS EndDate, TRUE AS IsCurrent FROM src),
t3 AS (SELECT CustomerID, Name, Region AS CurrentRegion, CAST(NULL AS VARCHAR) AS PreviousRegion,
  EffectiveDate AS LastUpdatedDate FROM src),
s2 AS (SELECT CustomerSK, CustomerID, Name, Region, StartDate,
    CASE WHEN CustomerID IN (SELECT CustomerID FROM chg) THEN DATE '{CLOSE_DATE}' ELSE EndDate END AS EndDate,
    CASE WHEN CustomerID IN (SELECT CustomerID FROM chg) THEN FALSE ELSE IsCurrent END AS IsCurrent FROM t2
  UNION ALL
  SELECT (SELECT MAX(CustomerSK) FROM t2) + ROW_NUMBER() OVER (ORDER BY CustomerID, EffectiveDate),
    CustomerID, Name, Region, EffectiveDate, DATE '9999-12-31', TRUE FROM chg)"""


def _init(spark, d, kind):
    return merge.scd_init(scd_source(spark, d), kind, KEYS, "Region", "EffectiveDate",
                          sk_col="CustomerSK", current_col="CurrentRegion", previous_col="PreviousRegion")


def _stored(spark, df, name):
    """A dimension is a table: written once, read by every step that follows."""
    path = files.write_layer(df, scratch_path(spark, name))
    return spark.read.schema(df.schema).parquet(path)


def _scd2(spark, d, target=None):
    t = target if target is not None else _stored(spark, _init(spark, d, 2), "dim_customer")
    return merge.scd2_apply(t, scd_changes(spark, d), KEYS, ["Name", "Region"], "EffectiveDate",
                            sk_col="CustomerSK")


@register("scd_init", q(_SCD_SQL + " SELECT * FROM t2"))
def scd_init(spark, d):
    return _init(spark, d, 2)


@register("scd1_merge", q(_SCD_SQL + """
SELECT COALESCE(t.CustomerID, s.CustomerID) AS CustomerID,
  CASE WHEN t.CustomerID IS NOT NULL THEN t.Name ELSE s.Name END AS Name,
  CASE WHEN s.CustomerID IS NOT NULL THEN s.Region ELSE t.Region END AS Region,
  CASE WHEN s.CustomerID IS NOT NULL THEN s.EffectiveDate ELSE t.LastUpdatedDate END AS LastUpdatedDate
FROM t1 t FULL OUTER JOIN chg s ON t.CustomerID = s.CustomerID"""))
def scd1_merge(spark, d):
    return merge.scd1_merge(_init(spark, d, 1), scd_changes(spark, d), KEYS, ["Region"], "EffectiveDate")


@register("scd2_apply", q(_SCD_SQL + " SELECT * FROM s2"))
def scd2_apply(spark, d):
    return _scd2(spark, d)


@register("scd3_apply", q(_SCD_SQL + """
, j AS (SELECT t.CustomerID AS tid, s.CustomerID AS sid, t.Name AS tname, s.Name AS sname, t.CurrentRegion,
  t.PreviousRegion, t.LastUpdatedDate, s.Region, s.EffectiveDate,
  (t.CustomerID IS NOT NULL AND s.CustomerID IS NOT NULL AND t.CurrentRegion IS DISTINCT FROM s.Region) AS changed
  FROM t3 t FULL OUTER JOIN chg s ON t.CustomerID = s.CustomerID)
SELECT COALESCE(tid, sid) AS CustomerID, CASE WHEN tid IS NOT NULL THEN tname ELSE sname END AS Name,
  CASE WHEN tid IS NULL OR changed THEN Region ELSE CurrentRegion END AS CurrentRegion,
  CASE WHEN changed THEN CurrentRegion WHEN tid IS NULL THEN NULL ELSE PreviousRegion END AS PreviousRegion,
  CASE WHEN tid IS NULL OR changed THEN EffectiveDate ELSE LastUpdatedDate END AS LastUpdatedDate FROM j"""))
def scd3_apply(spark, d):
    return merge.scd3_apply(_init(spark, d, 3), scd_changes(spark, d), KEYS, "Region", "EffectiveDate",
                            current_col="CurrentRegion", previous_col="PreviousRegion")


@register("insert_if_absent", q(_SCD_SQL + """
SELECT * FROM t1 UNION ALL
SELECT CustomerID, Name, Region, EffectiveDate FROM chg WHERE CustomerID NOT IN (SELECT CustomerID FROM t1)"""))
def insert_if_absent(spark, d):
    rows = scd_changes(spark, d).withColumnRenamed("EffectiveDate", "LastUpdatedDate")
    return merge.insert_if_absent(_init(spark, d, 1), rows, KEYS)


@register("change_counts", q(_SCD_SQL + """
, j AS (SELECT o.IsCurrent AS oc, n.IsCurrent AS nc FROM t2 o FULL OUTER JOIN s2 n ON o.CustomerSK = n.CustomerSK)
SELECT COUNT(oc) AS n_old, COUNT(nc) AS n_new, CAST(SUM(CASE WHEN oc IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_inserted,
  CAST(SUM(CASE WHEN oc AND NOT nc THEN 1 ELSE 0 END) AS BIGINT) AS n_closed,
  CAST(SUM(CASE WHEN oc IS NOT DISTINCT FROM nc THEN 1 ELSE 0 END) AS BIGINT) AS n_unchanged FROM j"""))
def change_counts(spark, d):
    t = _stored(spark, _init(spark, d, 2), "dim_customer")
    new = _stored(spark, _scd2(spark, d, t), "dim_customer_next")
    return merge.change_counts(t, new, sk_col="CustomerSK")


_AFFECTED_SQL = """
SELECT COUNT(*) FILTER (t_id IS NULL) AS n_inserted, COUNT(*) FILTER (changed) AS n_updated, 0::BIGINT AS n_deleted,
  COUNT(*) FILTER (t_id IS NOT NULL AND NOT changed) AS n_unchanged FROM j"""


@register("scd1_affected_rows", q(_SCD_SQL + """
, j AS (SELECT t.CustomerID AS t_id, t.CustomerID IS NOT NULL AND s.CustomerID IS NOT NULL AS changed
  FROM t1 t FULL JOIN chg s ON t.CustomerID = s.CustomerID)""" + _AFFECTED_SQL))
def scd1_affected_rows(spark, d):
    return merge.affected_rows(_init(spark, d, 1), _stored(spark, scd1_merge(spark, d), "dim_customer_next"), KEYS)


@register("scd3_affected_rows", q(_SCD_SQL + """
, j AS (SELECT t.CustomerID AS t_id, t.CustomerID IS NOT NULL AND s.CustomerID IS NOT NULL
  AND t.CurrentRegion IS DISTINCT FROM s.Region AS changed FROM t3 t FULL JOIN chg s ON t.CustomerID = s.CustomerID)"""
  + _AFFECTED_SQL))
def scd3_affected_rows(spark, d):
    return merge.affected_rows(_init(spark, d, 3), _stored(spark, scd3_apply(spark, d), "dim_customer_next"), KEYS)


def _late_changes(spark, d):
    """The change batch with planted faults: a second change on the same day, old dates and missing dates."""
    ch = scd_changes(spark, d)
    again = ch.where(F.col("CustomerID") % 5 == 0).withColumn("Region", F.lit("ZZ"))
    late = ch.where(F.col("CustomerID") % 7 == 0).withColumn("EffectiveDate", F.lit("2022-06-01").cast("date"))
    undated = ch.where(F.col("CustomerID") % 11 == 0).withColumn("EffectiveDate", F.lit(None).cast("date"))
    return ch.unionByName(again).unionByName(late).unionByName(undated)


@register("scd2_rejects", q(_SCD_SQL + f"""
SELECT CustomerID, Name, Region, EffectiveDate AS StartDate, 'same day' AS reason FROM chg WHERE CustomerID % 5 = 0
UNION ALL SELECT CustomerID, Name, Region, DATE '2022-06-01', 'out of order' FROM chg
  WHERE CustomerID % 7 = 0 AND CustomerID < {NEW_KEY_OFFSET}
UNION ALL SELECT CustomerID, Name, Region, NULL, 'no date' FROM chg WHERE CustomerID % 11 = 0"""))
def scd2_rejects(spark, d):
    return merge.scd2_apply(_stored(spark, _init(spark, d, 2), "dim_customer"), _late_changes(spark, d), KEYS, ["Name", "Region"], "EffectiveDate",
                            sk_col="CustomerSK", return_rejects=True)[1]


# ---------------------------------------------------------------- star schema

def dim_product(spark, d):
    p = T.products(spark, d).select("product_id", "product_name", "category", "price")
    return assign_keys(p, "product_key", [("product_name", "asc"), ("product_id", "asc")]) \
        .select("product_key", "product_id", "product_name", "category", "price")


def _sold_items(spark, d):
    # planted: the lines of every 97th order name products that do not exist
    return T.items(spark, d).select("order_id", "line_no", F.when(
        F.col("order_id") % 97 == 0, F.col("product_id") + UNKNOWN_PRODUCT_OFFSET).otherwise(F.col("product_id"))
        .alias("product_id"), "quantity")


def raw_sales(spark, d, dates=True):
    """Lines with their unit price and, with ``dates``, the order's customer and date; unmatched lines stay."""
    p = T.products(spark, d).select("product_id", F.col("price").alias("unit_price"))
    i = _sold_items(spark, d).join(p, "product_id", "left")
    return i.join(T.orders(spark, d).select("order_id", "customer_id", "purchase_ts"), "order_id", "left") if dates else i


def customers_natural(spark, d):
    return T.customers(spark, d).select("customer_id", "customer_name", F.col("state").alias("country"))


def dim_customer(spark, d):
    """Customers with a sold line, numbered by id."""
    sold = T.orders(spark, d).select("order_id", "customer_id").join(
        T.items(spark, d).select("order_id"), "order_id", "left_semi").select("customer_id")
    return star.load_dim(customers_natural(spark, d).join(sold, "customer_id", "left_semi"),
                         "customer_id", ["customer_name", "country"], "customer_key",
                         at_most=T.table(spark, d, "customer").count())


def fact_sales(spark, d):
    return star.load_fact(raw_sales(spark, d), dim_customer(spark, d), dim_product(spark, d),
                          date_col="purchase_ts", customer_id="customer_id", product_id="product_id",
                          price="unit_price", quantity="quantity", keep=["order_id", "line_no"],
                          sale_key="sale_key", key_rows=T.items(spark, d).select("order_id", "line_no"),
                          order=["order_id", "line_no", "date_key", "customer_key", "product_key", "quantity"])


def natural_fact(spark, d, dates=True):
    """The fact by natural keys, for reports that need no surrogate key."""
    f = raw_sales(spark, d, dates).withColumn("total_amount", (F.col("unit_price") * F.col("quantity")).cast(MONEY))
    return f.withColumn("date_key", star.date_key("purchase_ts")) if dates else f


_STAR_SQL = f"""
, sold AS (SELECT order_id, line_no, quantity, CASE WHEN order_id % 97 = 0 THEN product_id + {UNKNOWN_PRODUCT_OFFSET}
  ELSE product_id END AS product_id FROM c_items),
raw AS (SELECT i.order_id, i.line_no, o.customer_id, c.customer_name, c.state AS country, i.product_id,
  p.price AS unit_price, i.quantity, o.purchase_ts FROM sold i LEFT JOIN c_orders o ON i.order_id = o.order_id
  LEFT JOIN c_customers c ON o.customer_id = c.customer_id LEFT JOIN c_products p ON i.product_id = p.product_id),
dc AS (SELECT ROW_NUMBER() OVER (ORDER BY customer_id) AS customer_key, customer_id, customer_name, country
  FROM (SELECT DISTINCT customer_id, customer_name, country FROM raw WHERE country IS NOT NULL)),
dp AS (SELECT ROW_NUMBER() OVER (ORDER BY product_name, product_id) AS product_key, product_id, product_name,
  category, price FROM c_products),
f AS (SELECT CAST(year(purchase_ts) * 10000 + month(purchase_ts) * 100 + day(purchase_ts) AS INTEGER) AS date_key,
  dc.customer_key, dp.product_key, raw.order_id, raw.line_no, CAST(raw.quantity AS INTEGER) AS quantity,
  CAST(raw.unit_price * raw.quantity AS DECIMAL(18,2)) AS total_amount,
  (dc.customer_key IS NOT NULL AND dp.product_key IS NOT NULL) AS matched
  FROM raw LEFT JOIN dc ON raw.customer_id = dc.customer_id LEFT JOIN dp ON raw.product_id = dp.product_id),
fs AS (SELECT ROW_NUMBER() OVER (ORDER BY order_id, line_no, date_key, customer_key, product_key NULLS FIRST, quantity)
  AS sale_key, * FROM f),
span AS (SELECT CAST(MIN(purchase_ts) AS DATE) AS lo, CAST(MAX(purchase_ts) AS DATE) AS hi FROM c_orders),
dd AS (SELECT CAST(year(g) * 10000 + month(g) * 100 + day(g) AS INTEGER) AS date_key, CAST(g AS DATE) AS full_date,
  CAST(dayofweek(g) AS INTEGER) AS day_of_week, dayname(g) AS day_name, CAST(month(g) AS INTEGER) AS month,
  monthname(g) AS month_name, CAST(quarter(g) AS INTEGER) AS quarter, CAST(year(g) AS INTEGER) AS year
  FROM span, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS t(g))"""


@register("assign_keys", q(_STAR_SQL + " SELECT * FROM dp"))
def assign_keys_q(spark, d):
    return dim_product(spark, d)


@register("dim_date", q(_STAR_SQL + " SELECT * FROM dd"))
def dim_date(spark, d):
    return star.dim_date_for(T.orders(spark, d), "purchase_ts")


@register("load_dim", q(_STAR_SQL + " SELECT * FROM dc"))
def load_dim(spark, d):
    return dim_customer(spark, d)


@register("load_fact", q(_STAR_SQL + " SELECT * FROM fs"))
def load_fact(spark, d):
    return fact_sales(spark, d)


@register("sales_by_category_star", q(_STAR_SQL + """
SELECT dp.category, CAST(SUM(fs.total_amount) AS DECIMAL(18,2)) AS total_sales,
  CAST(SUM(fs.quantity) AS BIGINT) AS units FROM fs JOIN dp ON fs.product_key = dp.product_key
GROUP BY dp.category"""))
def sales_by_category_star(spark, d):
    return star.sales_by_category(natural_fact(spark, d, dates=False), T.products(spark, d), key="product_id")


@register("monthly_by_country", q(_STAR_SQL + """
SELECT dd.year, dd.month, dc.country, CAST(SUM(fs.total_amount) AS DECIMAL(18,2)) AS total_sales
FROM fs JOIN dd ON fs.date_key = dd.date_key JOIN dc ON fs.customer_key = dc.customer_key
GROUP BY dd.year, dd.month, dc.country"""))
def monthly_by_country(spark, d):
    return star.monthly_by_country(natural_fact(spark, d), dim_date(spark, d), customers_natural(spark, d),
                                   key="customer_id")


@register("top_customers_star", q(_STAR_SQL + """
SELECT dc.customer_id, dc.customer_name, CAST(SUM(fs.total_amount) AS DECIMAL(18,2)) AS total_sales
FROM fs JOIN dc ON fs.customer_key = dc.customer_key GROUP BY dc.customer_id, dc.customer_name
ORDER BY total_sales DESC, dc.customer_id LIMIT 5"""))
def top_customers_star(spark, d):
    return star.top_customers(natural_fact(spark, d), customers_natural(spark, d), 5, key="customer_id")
