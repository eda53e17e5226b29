"""Source and audit queries: CSV reads, layer writes and a load audit."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakemart.operators import conform
from lakemart.plans import tables as T
from lakemart.plans.conform_q import ORDER_SPEC, bronze_orders
from lakemart.plans.registry import register
from lakemart.session import scratch_path
from lakemart.sources import by_name, files, metadata, snapshots

LOAD_ID, LOAD_TS = "load-0001", "2024-02-01 06:00:00"


@register("bronze_csv_roundtrip", """
SELECT TRY_CAST(o_orderkey AS BIGINT) AS order_id, TRY_CAST(o_custkey AS BIGINT) AS customer_id,
  lower(o_orderstatus) AS status, o_orderdate AS purchase_ts,
  TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,2)) AS order_total, upper(o_orderpriority) AS priority
FROM orders""")
def bronze_csv_roundtrip(spark, d):
    """orders → CSV in the shared scratch folder → all-string bronze → conformed silver."""
    path = scratch_path(spark, "bronze_orders_csv")
    bronze_orders(spark, d).write.mode("overwrite").option("header", True).csv(path)
    raw = files.read_bronze_csv(spark, path, infer=False, rescued="_rescued_data")
    return conform.conform(raw, ORDER_SPEC, on_error="null")


@register("load_audit", f"""
SELECT '{LOAD_ID}' AS load_id, 'events.parquet' AS file_name, TIMESTAMP '{LOAD_TS}' AS load_date,
  COUNT(*) AS record_count, MIN(ts) AS min_timestamp, MAX(ts) AS max_timestamp,
  CAST(SUM(CASE WHEN user_id IS NULL OR event_type IS NULL OR ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
  COUNT(*) - COUNT(DISTINCT event_id) AS duplicate_count,
  CASE WHEN SUM(CASE WHEN user_id IS NULL OR event_type IS NULL OR ts IS NULL THEN 1 ELSE 0 END) = COUNT(*) THEN 'FAILED'
       WHEN SUM(CASE WHEN user_id IS NULL OR event_type IS NULL OR ts IS NULL THEN 1 ELSE 0 END) > 0
         OR COUNT(*) - COUNT(DISTINCT event_id) > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status
FROM events""")
def load_audit(spark, d):
    scan = metadata.with_load_metadata(T.table(spark, d, "events"), LOAD_ID, LOAD_TS)
    return metadata.load_audit(scan, "ts", "event_id", ["user_id", "event_type", "ts"])


def _rescued_text(c):
    """The rescue map as text: its entries by name, without the file's path (a scratch folder)."""
    kept = F.filter(F.array_sort(F.map_entries(c)), lambda e: e["key"] != by_name.FILE)
    return F.when(F.col(c).isNotNull(), F.array_join(F.transform(kept, lambda e: F.concat_ws("=", e["key"], e["value"])), ";"))


@register("bronze_csv_rescued", """
SELECT CASE WHEN o_orderkey % 70 <> 0 THEN o_orderkey END AS order_id, CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS order_total,
  'ref, ' || o_orderpriority AS note, NULLIF(concat_ws(';', CASE WHEN o_orderkey % 70 = 0 THEN 'order_id=#' || o_orderkey END,
  CASE WHEN o_orderkey % 50 = 0 THEN 'order_total=oops' END), '') AS rescued
FROM orders""")
def bronze_csv_rescued(spark, d):
    """Planted: a text in the number column of every 50th line, in the key of every 70th. Only those fields are rescued."""
    path = scratch_path(spark, "bronze_dirty_csv")
    o = T.table(spark, d, "orders")
    total = F.when(F.col("o_orderkey") % 50 == 0, "oops").otherwise(F.col("o_totalprice").cast("string"))
    key = F.when(F.col("o_orderkey") % 70 == 0, F.concat(F.lit("#"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    o.select(F.concat_ws(",", key, total, F.concat(F.lit('"ref, '), "o_orderpriority", F.lit('"')))).write.text(path)
    schema = StructType([StructField("order_id", LongType()), StructField("order_total", DoubleType()),
                         StructField("note", StringType())])
    rows = by_name.read_csv_by_name(spark, path, schema, rescued="rescued", header=False)
    return rows.withColumn("rescued", _rescued_text("rescued"))


@register("bronze_csv_by_name", """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderstatus END AS status, o_totalprice AS order_total,
  CASE WHEN o_orderkey % 4 = 2 THEN 'Channel=web ' || (o_orderkey % 7) || ';note=a, "b"' END AS rescued FROM orders""")
def bronze_csv_by_name(spark, d):
    """One folder of files whose headers differ: as expected, in another order, with new columns, and with one missing."""
    path = scratch_path(spark, "bronze_unequal_headers")
    o = T.table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                                           F.col("o_totalprice").alias("order_total"))
    o = o.withColumn("Channel", F.concat(F.lit("web "), F.col("o_orderkey") % 7)).withColumn("note", F.lit('a, "b"'))
    for i, cols in enumerate((["order_id", "status", "order_total"], ["order_total", "order_id", "status"],
                              ["Channel", "STATUS", "note", "order_id", "order_total"], ["order_id", "order_total"])):
        part = o.where(F.col("o_orderkey") % 4 == i).select(*[F.col(c).alias(c) for c in cols])
        part.write.mode("append").option("header", True).option("escape", '"').csv(path)
    schema = StructType([StructField("order_id", LongType()), StructField("status", StringType()), StructField("order_total", DoubleType())])
    rows = by_name.read_csv_by_name(spark, path, schema, rescued="rescued", escape='"')
    return rows.withColumn("rescued", _rescued_text("rescued"))


@register("rerun_load_day", """
WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), bad AS (SELECT day FROM days ORDER BY day LIMIT 2)
SELECT event_id, event_type, CASE WHEN CAST(ts AS DATE) IN (SELECT day FROM bad) THEN user_id + 1 ELSE user_id END AS user_id,
  CAST(ts AS DATE) AS load_day FROM events
WHERE NOT (CAST(ts AS DATE) IN (SELECT day FROM bad) AND event_id % 3 = 0)""")
def rerun_load_day(spark, d):
    """A layer by load day; the first two days are loaded again with other rows and replace only themselves."""
    path = scratch_path(spark, "daily_layer")
    e = T.table(spark, d, "events").select("event_id", "event_type", "user_id", F.col("ts").cast("date").alias("load_day"))
    snapshots.replace_partitions(e, path, ["load_day"])
    bad = e.select("load_day").distinct().orderBy("load_day").limit(2)
    again = e.join(F.broadcast(bad), "load_day", "left_semi").where("event_id % 3 <> 0").withColumn("user_id", F.col("user_id") + 1)
    snapshots.replace_partitions(again.select(*e.columns), path, ["load_day"])
    return snapshots.read_partitions(spark, path, e.schema)


@register("write_audit", f"""
SELECT '{LOAD_ID}' AS load_id, COUNT(*) AS record_count, MIN(ts) AS min_timestamp, MAX(ts) AS max_timestamp,
  COUNT(*) FILTER (uid IS NULL OR event_type IS NULL OR ts IS NULL) AS null_count,
  COUNT(*) FILTER (NOT COALESCE(value >= 10, FALSE)) AS small_value, 'PARTIAL' AS load_status
FROM (SELECT *, CASE WHEN event_id % 20 <> 0 THEN user_id END AS uid FROM events)""")
def write_audit(spark, d):
    """The audit of a layer, observed while it is written. Planted: every 20th user is missing."""
    e = T.table(spark, d, "events").withColumn("user_id", F.when(F.col("event_id") % 20 != 0, F.col("user_id")))
    return snapshots.write_audited(e, scratch_path(spark, "audited_layer"), LOAD_ID, "ts", ["user_id", "event_type", "ts"],
                                   checks={"small_value": F.col("value") >= 10})


@register("order_totals_view", """
SELECT o_orderstatus AS status, COUNT(*) AS n_orders, MAX(o_orderkey) AS last_order FROM orders GROUP BY o_orderstatus""")
def order_totals_view(spark, d):
    """Through named views: one over the table, replaced by a narrower one, and a query on it."""
    files.register_views({"lakemart_orders_v": T.table(spark, d, "orders")})
    files.register_views({"lakemart_orders_v": spark.table("lakemart_orders_v").select("o_orderkey", "o_orderstatus")})
    return spark.sql("SELECT o_orderstatus AS status, COUNT(*) AS n_orders, MAX(o_orderkey) AS last_order "
                     "FROM lakemart_orders_v GROUP BY o_orderstatus")


@register("bronze_csv_inferred", """
SELECT o_orderkey AS order_id, o_totalprice AS order_total, o_orderstatus AS status, 'double' AS total_type,
  'string' AS status_type FROM orders""")
def bronze_csv_inferred(spark, d):
    """A CSV with a header, types inferred from the data."""
    path = scratch_path(spark, "bronze_inferred_csv")
    T.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.option("header", True).csv(path)
    raw = files.read_bronze_csv(spark, path, infer=True, rescued=None)
    types = dict(raw.dtypes)
    return raw.select(F.col("o_orderkey").cast("bigint").alias("order_id"), F.col("o_totalprice").alias("order_total"),
                      F.col("o_orderstatus").alias("status"), F.lit(types["o_totalprice"]).alias("total_type"),
                      F.lit(types["o_orderstatus"]).alias("status_type"))


@register("append_layer", """
SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_custkey AS BIGINT) AS customer_id FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS BIGINT) FROM orders WHERE o_orderkey % 10 = 0""")
def append_layer(spark, d):
    """A layer table, then rows appended by column name, in another order and type."""
    path = scratch_path(spark, "append_layer")
    o = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                                           F.col("o_custkey").cast("bigint").alias("customer_id"))
    files.write_layer(o, path)
    more = o.where(F.col("order_id") % 10 == 0).select(F.col("customer_id").cast("string").alias("customer_id"), "status", "order_id")
    files.append_layer(more, path, o.schema)
    return spark.read.schema(o.schema).parquet(path)


@register("partitioned_layer", """
SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'""")
def partitioned_layer(spark, d):
    """A table partitioned on write; the filter on the partition column prunes the read."""
    path = scratch_path(spark, "partitioned_layer")
    o = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("priority"),
                                           F.col("o_orderstatus").alias("status"))
    files.write_layer(o, path, partition_by=["status"])
    return spark.read.schema(o.schema).parquet(path).where(F.col("status") == "F")


@register("text_as_number", """
SELECT order_id, amount FROM (SELECT o_orderkey AS order_id,
  TRY_CAST(CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS DOUBLE) AS amount
  FROM orders) WHERE amount > 200000""")
def text_as_number(spark, d):
    """A text column compared as a number: values that are no numbers are null and drop out."""
    o = T.table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 13 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    return o.select(F.col("o_orderkey").alias("order_id"), text.try_cast("double").alias("amount")).where("amount > 200000")
