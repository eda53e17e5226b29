"""Conform / filter queries and the lead and tap reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions.columns import MONEY
from lakemart.operators import conform, leads, relational, sales, transit, typos
from lakemart.operators.conform import Field
from lakemart.plans import tables as T
from lakemart.plans.registry import register
from lakemart.plans.sqlfrag import avg_exact, q, ratio

# fixed values of the reports
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
NULL_TOKENS = ("", "N/A", "NULL", "UNKNOWN", "TBC", "4-NOT SPECIFIED")
SEGMENT_MAP = {"automobile": "AUTOMOTIVE", "machinery": "INDUSTRIAL", "building": "CONSTRUCTION"}
LEAD_REGIONS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")
LEAD_AS_OF = "1998-08-31"
TAPS_AS_OF = "2024-01-25 00:00:00"  # inside the data, so that later taps drop out
HIGH_VALUE = 300000
RECENT_TAP_DAYS = 7

ORDER_SPEC = [
    Field("order_id", "o_orderkey", "bigint"),
    Field("customer_id", "o_custkey", "bigint"),
    Field("status", "o_orderstatus", "string", fold="lower"),
    Field("purchase_ts", "o_orderdate", "timestamp_ntz", fmt=TS_FORMAT),
    Field("order_total", "o_totalprice", "decimal(18,2)"),
    Field("priority", "o_orderpriority", "string", fold="upper"),
]


def bronze_orders(spark, d):
    """The orders table as an all-string bronze table (how CSV lands)."""
    o = T.table(spark, d, "orders")
    return o.select(*[F.col(c).cast("string").alias(c) for c in o.columns])


@register("conform_orders", q("""
SELECT TRY_CAST(o_orderkey AS BIGINT) AS order_id, TRY_CAST(o_custkey AS BIGINT) AS customer_id,
  lower(o_orderstatus) AS status, o_orderdate AS purchase_ts,
  TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(18,2)) AS order_total, upper(o_orderpriority) AS priority
FROM orders"""))
def conform_orders(spark, d):
    return conform.conform(bronze_orders(spark, d), ORDER_SPEC, on_error="null")


@register("normalise_text", q("""
SELECT customer_id, UPPER(TRIM(customer_name)) AS customer_name, state, UPPER(TRIM(segment)) AS segment
FROM c_customers"""))
def normalise_text(spark, d):
    c = T.customers(spark, d).select("customer_id", "customer_name", "state", "segment")
    return conform.normalise_text(c, ["customer_name", "segment"])


_TOKENS_SQL = ", ".join("'" + t.upper() + "'" for t in NULL_TOKENS)


@register("null_tokens", q(f"""
SELECT order_id, status, CASE WHEN UPPER(TRIM(priority)) IN ({_TOKENS_SQL}) THEN NULL ELSE priority END
  AS priority FROM c_orders"""))
def null_tokens(spark, d):
    o = T.orders(spark, d).select("order_id", "status", "priority")
    return conform.null_tokens(o, ["priority"], NULL_TOKENS)


_MAP_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_MAP.items())


@register("canonicalise", q(f"""
SELECT customer_id, segment, CASE lower(trim(segment)) {_MAP_SQL} ELSE segment END AS segment_canonical
FROM c_customers"""))
def canonicalise(spark, d):
    c = T.customers(spark, d).select("customer_id", "segment")
    return conform.canonicalise(c, "segment", SEGMENT_MAP, out="segment_canonical")


@register("fill_defaults", q("""
SELECT o.order_id, o.status, COALESCE(r.revenue, CAST(0 AS DECIMAL(18,2))) AS revenue,
  COALESCE(r.n_items, 0) AS n_items FROM c_orders o LEFT JOIN c_revenue r ON o.order_id = r.order_id"""))
def fill_defaults(spark, d):
    o = T.orders(spark, d).select("order_id", "status")
    r = sales.order_revenue(T.items(spark, d))
    return relational.fill_defaults(o.join(r, "order_id", "left"), {"revenue": 0, "n_items": 0})


def _taps_as_of():
    return F.lit(TAPS_AS_OF).cast("timestamp_ntz")


@register("within_days", q(f"""
SELECT event_id, station_name, passengers, tap_ts, user_id FROM c_taps
WHERE tap_ts >= TIMESTAMP '{TAPS_AS_OF}' - INTERVAL {RECENT_TAP_DAYS} DAY AND tap_ts <= TIMESTAMP '{TAPS_AS_OF}'"""))
def within_days(spark, d):
    t = T.taps(spark, d)
    return conform.within_last(t, "tap_ts", RECENT_TAP_DAYS, _taps_as_of())


@register("count_if_report", q("""
SELECT COUNT(*) AS total_rows,
  CAST(SUM(CASE WHEN return_flag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
  CAST(SUM(CASE WHEN discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS high_discount,
  CAST(SUM(CASE WHEN tax = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_tax,
  CAST(SUM(CASE WHEN quantity > 45 THEN 1 ELSE 0 END) AS BIGINT) AS big_quantity FROM c_items"""))
def count_if_report(spark, d):
    i = T.items(spark, d)
    return relational.count_if_report(i, {
        "returned": F.col("return_flag") == "R",
        "high_discount": F.col("discount") > F.lit(0.05).cast(MONEY),
        "zero_tax": F.col("tax") == 0,
        "big_quantity": F.col("quantity") > 45,
    })


_REGIONS_SQL = ", ".join(f"'{r}'" for r in LEAD_REGIONS)


@register("top_segments", q(f"""
SELECT region, COUNT(*) AS converted_leads FROM c_leads
WHERE created_date >= date_trunc('month', DATE '{LEAD_AS_OF}') AND created_date <= DATE '{LEAD_AS_OF}'
  AND region IN ({_REGIONS_SQL}) AND status = 'converted'
GROUP BY region HAVING COUNT(*) > 0 ORDER BY converted_leads DESC, region LIMIT 5"""))
def top_segments(spark, d):
    return leads.top_regions_converted(T.leads(spark, d), LEAD_REGIONS, F.lit(LEAD_AS_OF).cast("date"), 5)


@register("lead_metrics", q(f"""
SELECT region, COUNT(*) AS total_leads,
  CAST(SUM(CASE WHEN status = 'converted' THEN 1 ELSE 0 END) AS BIGINT) AS converted,
  {avg_exact("CASE WHEN deal_value > 0 THEN deal_value END", 2, 2)} AS avg_deal_value,
  {ratio("SUM(CASE WHEN status = 'converted' THEN 1 ELSE 0 END)", "COUNT(*)", 2, pct=True)} AS conversion_rate_pct
FROM c_leads GROUP BY region"""))
def lead_metrics(spark, d):
    return leads.lead_metrics(T.leads(spark, d))


@register("conversion_rate", q(f"""
SELECT COUNT(*) AS total_leads, CAST(SUM(CASE WHEN status = 'converted' THEN 1 ELSE 0 END) AS BIGINT) AS converted,
  {ratio("SUM(CASE WHEN status = 'converted' THEN 1 ELSE 0 END)", "COUNT(*)", 2, pct=True)} AS conversion_rate_pct
FROM c_leads"""))
def conversion_rate(spark, d):
    return leads.conversion_rate(T.leads(spark, d))


@register("high_value_deals", q(f"""
SELECT source, COUNT(*) AS high_value_deals, CAST(SUM(deal_value) AS DECIMAL(18,2)) AS total_value
FROM c_leads WHERE deal_value > {HIGH_VALUE} GROUP BY source"""))
def high_value_deals(spark, d):
    return leads.high_value_deals(T.leads(spark, d, value_above=HIGH_VALUE), HIGH_VALUE)


@register("top_stations", q(f"""
, g AS (SELECT station_name, CAST(SUM(passengers) AS DECIMAL(18,2)) AS total_passengers, COUNT(*) AS tap_events,
  {avg_exact("passengers", 2, 2)} AS avg_passengers_per_event
  FROM c_taps WHERE station_name IS NOT NULL AND passengers BETWEEN 1 AND 300
    AND tap_ts >= TIMESTAMP '{TAPS_AS_OF}' - INTERVAL 15 DAY AND tap_ts <= TIMESTAMP '{TAPS_AS_OF}'
  GROUP BY station_name HAVING COUNT(*) > 10)
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY total_passengers DESC, station_name) AS BIGINT) AS rank
FROM g ORDER BY total_passengers DESC, station_name LIMIT 5"""))
def top_stations(spark, d):
    t = T.taps(spark, d)
    return transit.top_stations(t, 15, 10, _taps_as_of(), 5)


@register("stage_events", q(f"""
SELECT event_id, UPPER(TRIM(station_name)) AS station_name, passengers, tap_ts, user_id FROM c_taps
WHERE tap_ts <= TIMESTAMP '{TAPS_AS_OF}' AND passengers BETWEEN 1 AND 300
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY tap_ts DESC, event_id DESC) = 1"""))
def stage_events(spark, d):
    t = T.taps(spark, d)
    return conform.stage_events(t, {"passengers": (1, 300)}, ["user_id"], ["tap_ts", "event_id"],
                                "tap_ts", _taps_as_of(), ["station_name"])


# planted in the customers' states: a character lost, two exchanged, one replaced, one added, case and blanks, null, blank, unknown
_TYPED_SQL = """
, typed AS (SELECT customer_id, CASE customer_id % 8 WHEN 1 THEN left(state, length(state) - 1)
  WHEN 2 THEN substr(state, 1, 1) || substr(state, 3, 1) || substr(state, 2, 1) || substr(state, 4)
  WHEN 3 THEN 'X' || substr(state, 2) WHEN 4 THEN substr(state, 1, 3) || 'E' || substr(state, 4) WHEN 5 THEN '  ' || lower(state) || ' '
  WHEN 6 THEN CASE customer_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE state || ' OVERSEAS' END ELSE state END AS state FROM c_customers),
vals AS (SELECT state AS value, upper(trim(state)) AS f, COUNT(*) AS n_rows FROM typed GROUP BY state),
near AS (SELECT f, n, list_sort(list(DISTINCT n_name)) AS names FROM (SELECT f, n_name, CASE WHEN damerau_levenshtein(f, n_name) = 1 THEN 1
  ELSE levenshtein(f, n_name) END AS n FROM (SELECT DISTINCT f FROM vals WHERE f <> ''), nation) WHERE n <= {k} GROUP BY f, n
  QUALIFY ROW_NUMBER() OVER (PARTITION BY f ORDER BY n) = 1),
res AS (SELECT value, n_rows, CASE WHEN v.f IS NULL OR v.f = '' THEN 'missing' WHEN n IS NULL THEN 'unknown' WHEN n = 0 THEN 'exact'
  WHEN len(names) = 1 THEN 'repaired' ELSE 'ambiguous' END AS status, CASE WHEN len(names) = 1 THEN names[1] END AS fixed,
  CAST(n AS INTEGER) AS n_edits, CASE WHEN len(names) > 1 THEN array_to_string(names, '|') END AS candidates
  FROM vals v LEFT JOIN near ON v.f = near.f)
"""


def _typed_states(spark, d):
    c, s, by = T.customers(spark, d).select("customer_id", "state"), F.col("state"), F.col("customer_id")
    lost = F.when(by % 3 == 1, " ").when(by % 3 == 2, F.concat(s, F.lit(" OVERSEAS")))
    typed = (F.when(by % 8 == 1, F.expr("left(state, length(state) - 1)"))
             .when(by % 8 == 2, F.expr("concat(substr(state, 1, 1), substr(state, 3, 1), substr(state, 2, 1), substr(state, 4))"))
             .when(by % 8 == 3, F.expr("concat('X', substr(state, 2))"))
             .when(by % 8 == 4, F.expr("concat(substr(state, 1, 3), 'E', substr(state, 4))"))
             .when(by % 8 == 5, F.concat(F.lit("  "), F.lower(s), F.lit(" "))).when(by % 8 == 6, lost).otherwise(s))
    return c.select("customer_id", typed.alias("state"))


@register("repair_states", q(_TYPED_SQL.format(k=1) + """
SELECT customer_id, state, COALESCE(fixed, state) AS state_fixed, status FROM typed t JOIN res ON t.state IS NOT DISTINCT FROM res.value"""))
def repair_states(spark, d):
    """Planted typos of the states, none of them listed anywhere, brought back to the names in ``nation``."""
    allowed = T.table(spark, d, "nation").select(F.col("n_name").alias("value"))
    return typos.repair_values(_typed_states(spark, d), "state", allowed, 1, out="state_fixed")


@register("typo_report", q(_TYPED_SQL.format(k=2) + "SELECT * FROM res"))
def typo_report(spark, d):
    allowed = T.table(spark, d, "nation").select(F.col("n_name").alias("value"))
    return typos.typo_report(_typed_states(spark, d), "state", allowed, 2)
