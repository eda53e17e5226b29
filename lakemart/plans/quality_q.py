"""Data-quality queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakemart.functions.columns import MONEY
from lakemart.operators import quality, sales, zones
from lakemart.plans import tables as T
from lakemart.plans.conform_q import bronze_orders
from lakemart.plans.registry import register
from lakemart.plans.sqlfrag import avg_exact, half_up, month, q, ratio

# fixed check parameters
AS_OF = "2001-06-30 00:00:00"
TOO_OLD = "1995-06-01 00:00:00"
TAPS_AS_OF = "2024-01-25 00:00:00"  # inside the data, so that there are future rows
LANGS = ("en", "de", "fr")
PROFILE_COLS = ("order_id", "customer_id", "status", "purchase_ts", "order_total", "priority")
NULL_COLS = ("order_id", "status", "revenue", "n_items")
DISTINCT_COLS = ("order_id", "product_id", "seller_id", "return_flag", "line_status")
TEXT_COLS = ("text", "lang", "source")
PATTERNS = {"customer_name": "^Customer#[0-9]{9}$", "segment": "^[A-Z]+$"}
CASTS = {"o_orderkey": "bigint", "o_orderstatus": "int", "o_totalprice": "decimal(18,2)"}


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _orders_revenue(spark, d):
    o = T.orders(spark, d).select("order_id", "status")
    return o.join(sales.order_revenue(T.items(spark, d)), "order_id", "left")


_OR_SQL = """, orv AS (SELECT o.order_id, o.status, r.revenue, r.n_items FROM c_orders o
  LEFT JOIN c_revenue r ON o.order_id = r.order_id)"""


def _lines(spark, d):
    i = T.items(spark, d).select("order_id", "shipped_ts", "price", "discount", "tax", "return_flag")
    return i.join(T.orders(spark, d).select("order_id", "purchase_ts"), "order_id")


_LINES_SQL = """, ln AS (SELECT i.order_id, i.shipped_ts, i.price, i.discount, i.tax, i.return_flag, o.purchase_ts
  FROM c_items i JOIN c_orders o ON i.order_id = o.order_id)"""


@register("profile", q(_union([f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_nulls,
  COUNT(DISTINCT {c}) AS n_distinct, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value
  FROM c_orders""" for c in PROFILE_COLS])))
def profile(spark, d):
    return quality.profile(T.orders(spark, d), PROFILE_COLS)


@register("null_report", q(_OR_SQL + _union([f"""SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS n_nulls,
  {ratio(f'COUNT(*) - COUNT({c})', 'COUNT(*)', 2, pct=True)} AS null_pct FROM orv""" for c in NULL_COLS])))
def null_report(spark, d):
    return quality.null_report(_orders_revenue(spark, d), NULL_COLS)


@register("distinct_report", q(_union([f"""SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_distinct
  FROM c_items""" for c in DISTINCT_COLS])))
def distinct_report(spark, d):
    return quality.distinct_report(T.items(spark, d), DISTINCT_COLS)


@register("completeness", q(_OR_SQL + _union([f"""SELECT '{c}' AS column_name, COUNT({c}) AS n_non_null,
  {ratio(f'COUNT({c})', 'COUNT(*)', 2, pct=True)} AS completeness_pct FROM orv""" for c in NULL_COLS])))
def completeness(spark, d):
    return quality.completeness(_orders_revenue(spark, d), NULL_COLS)


@register("time_coverage", q(_LINES_SQL + _union([f"""SELECT '{c}' AS column_name, COUNT({c}) AS n_non_null,
  MIN({c}) AS first_ts, MAX({c}) AS last_ts, CAST(datediff('day', MIN({c}), MAX({c})) AS BIGINT) AS span_days
  FROM ln""" for c in ("purchase_ts", "shipped_ts")])))
def time_coverage(spark, d):
    return quality.time_coverage(_lines(spark, d), ["purchase_ts", "shipped_ts"])


@register("key_uniqueness", q("""
, k AS (SELECT order_id, line_no, COUNT(*) AS c FROM c_items GROUP BY order_id, line_no)
SELECT CAST(SUM(c) AS BIGINT) AS total_rows, COUNT(*) AS unique_keys,
  CAST(SUM(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys,
  CAST(SUM(CASE WHEN c > 1 THEN c ELSE 0 END) AS BIGINT) AS rows_in_duplicates, MAX(c) AS max_per_key FROM k"""))
def key_uniqueness(spark, d):
    return quality.key_uniqueness(T.items(spark, d), ["order_id", "line_no"])


@register("duplicate_rows", """
SELECT lang, text, COUNT(*) AS n_copies FROM documents GROUP BY lang, text HAVING COUNT(*) > 1""")
def duplicate_rows(spark, d):
    return quality.duplicate_rows(T.table(spark, d, "documents").select("lang", "text"))


_REFS = [("orders->customer", "orders", "o_custkey", "customer", "c_custkey"),
         ("lineitem->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
         ("lineitem->part", "lineitem", "l_partkey", "part", "p_partkey"),
         ("lineitem->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
         ("labels->documents", "labels", "doc_id", "documents", "doc_id")]


def _faulty_key(k: str) -> str:
    """Planted: some keys point nowhere, some are NULL (the tables themselves have no orphans)."""
    return f"CASE WHEN {k} % 101 = 0 THEN {k} + 5000000000 WHEN {k} % 103 = 0 THEN NULL ELSE {k} END"


@register("referential_check", _union([f"""SELECT '{name}' AS relation, COUNT(*) AS n_rows,
  CAST(SUM(CASE WHEN c.k IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null_keys,
  CAST(SUM(CASE WHEN c.k IS NOT NULL AND p.{pk} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_orphans
  FROM (SELECT {_faulty_key(ck)} AS k FROM {child}) c LEFT JOIN {parent} p ON p.{pk} = c.k""" for name, child, ck, parent, pk in _REFS]))
def referential_check(spark, d):
    out = None
    for name, child, ck, parent, pk in _REFS:
        rows = T.table(spark, d, child).select(F.expr(_faulty_key(ck)).alias("k"))
        r = quality.referential_check(rows, T.table(spark, d, parent), "k", pk, name)
        out = r if out is None else out.unionByName(r)
    return out


def _sanity_rules():
    return {"shipped_before_order": F.col("shipped_ts") < F.col("purchase_ts"),
            "shipped_in_future": F.col("shipped_ts") > _ts(AS_OF),
            "ordered_too_long_ago": F.col("purchase_ts") < _ts(TOO_OLD)}


_SANITY_SQL = {"shipped_before_order": "shipped_ts < purchase_ts",
               "shipped_in_future": f"shipped_ts > TIMESTAMP '{AS_OF}'",
               "ordered_too_long_ago": f"purchase_ts < TIMESTAMP '{TOO_OLD}'"}


def _rules_sql(rules, src, count_name="n_matching"):
    return _union([f"""SELECT '{n}' AS rule, COUNT(*) AS n_rows,
  CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT) AS {count_name} FROM {src}""" for n, p in rules.items()])


@register("timestamp_sanity", q(_LINES_SQL + _rules_sql(_SANITY_SQL, "ln")))
def timestamp_sanity(spark, d):
    return quality.timestamp_sanity(_lines(spark, d), _sanity_rules())


@register("string_lengths", _union([f"""SELECT '{c}' AS column_name, CAST(MIN(length({c})) AS BIGINT) AS min_len,
  CAST(MAX(length({c})) AS BIGINT) AS max_len, {avg_exact(f'length({c})', 0, 2)} AS avg_len
  FROM documents""" for c in TEXT_COLS]))
def string_lengths(spark, d):
    return quality.string_lengths(T.table(spark, d, "documents"), TEXT_COLS)


_LANGS_SQL = ", ".join(f"'{x}'" for x in LANGS)


@register("domain_check", f"""
SELECT lang AS value, COUNT(*) AS n,
  {ratio('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 2, pct=True)} AS pct,
  COALESCE(lang IN ({_LANGS_SQL}), FALSE) AS is_allowed FROM documents GROUP BY lang""")
def domain_check(spark, d):
    return quality.domain_check(T.table(spark, d, "documents"), "lang", LANGS)


_RANGE_SQL = {"negative_quantity": "quantity < 0", "big_quantity": "quantity > 45",
              "discount_out_of_range": "discount < 0 OR discount > 0.1",
              "tax_outlier": "tax > 0.08", "price_outlier": "price > 100000"}


@register("range_check", q(_rules_sql(_RANGE_SQL, "c_items")))
def range_check(spark, d):
    c = F.col
    return quality.range_check(T.items(spark, d), {
        "negative_quantity": c("quantity") < 0, "big_quantity": c("quantity") > 45,
        "discount_out_of_range": (c("discount") < 0) | (c("discount") > F.lit(0.1).cast(MONEY)),
        "tax_outlier": c("tax") > F.lit(0.08).cast(MONEY), "price_outlier": c("price") > 100000})


@register("duration_stats", q(_LINES_SQL + f"""
, x AS (SELECT datediff('day', purchase_ts, shipped_ts) AS dd FROM ln)
SELECT COUNT(dd) AS n, CAST(MIN(dd) AS BIGINT) AS min_days, CAST(MAX(dd) AS BIGINT) AS max_days,
  {avg_exact('dd', 0, 4)} AS avg_days, ROUND(stddev_samp(dd), 6) AS stddev_days FROM x"""))
def duration_stats(spark, d):
    return quality.duration_stats(_lines(spark, d), "purchase_ts", "shipped_ts")


@register("on_time_report", q(f"""
, s AS (SELECT order_id, MAX(shipped_ts) AS delivered_ts FROM c_items GROUP BY order_id),
lab AS (SELECT CASE WHEN s.delivered_ts IS NULL THEN 'Pending'
  WHEN s.delivered_ts <= o.purchase_ts + INTERVAL 30 DAY THEN 'On-time' ELSE 'Late' END AS delivery_status
  FROM c_orders o LEFT JOIN s ON o.order_id = s.order_id)
SELECT delivery_status, COUNT(*) AS n_orders,
  {ratio('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 2, pct=True)} AS pct FROM lab GROUP BY delivery_status"""))
def on_time_report(spark, d):
    return quality.on_time_report(sales.delivery_status(T.orders(spark, d), T.items(spark, d), 30))


_DIST_SQL = """, x AS (SELECT CAST(price AS DOUBLE) AS v FROM c_items), mu AS (SELECT AVG(v) AS m FROM x)"""


@register("distribution_exact", q(_DIST_SQL + """
SELECT COUNT(v) AS n, ROUND(quantile_cont(v, 0.25), 6) AS p25, ROUND(quantile_cont(v, 0.5), 6) AS p50,
  ROUND(quantile_cont(v, 0.75), 6) AS p75, ROUND(AVG(v), 6) AS mean, ROUND(stddev_samp(v), 6) AS stddev,
  ROUND(AVG(POWER(v - m, 3)) / POWER(AVG(POWER(v - m, 2)), 1.5), 6) AS skewness,
  ROUND(AVG(POWER(v - m, 4)) / POWER(AVG(POWER(v - m, 2)), 2) - 3, 6) AS kurtosis FROM x, mu"""))
def distribution_exact(spark, d):
    return quality.distribution(T.items(spark, d), "price", exact=True)


@register("distribution_approx", None)
def distribution_approx(spark, d):
    return quality.distribution(T.items(spark, d), "price", exact=False)


@register("distribution_approx_within", "SELECT TRUE AS p25_ok, TRUE AS p50_ok, TRUE AS p75_ok")
def distribution_approx_within(spark, d):
    """Is the exact rank of each approximate quartile within the stated error (1/10000 of the rows, and one row)?"""
    items = T.items(spark, d).select("price")
    q = quality.distribution(items, "price", exact=False)
    x = items.select(F.col("price").cast("double").alias("v")).withColumn(
        "q", q.select(F.struct("n", "p25", "p50", "p75")).scalar())
    ok = []
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        n, slack = F.max("q.n"), F.max("q.n") / 10000 + 1
        below, upto = F.count(F.when(F.col("v") < F.col(f"q.{name}"), 1)), F.count(F.when(F.col("v") <= F.col(f"q.{name}"), 1))
        ok.append(((below <= n * p + slack) & (upto >= n * p - slack)).alias(f"{name}_ok"))
    return x.agg(*ok)


@register("iqr_outliers", q(_DIST_SQL + """
, qq AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM x)
SELECT ROUND(q1, 6) AS q1, ROUND(q3, 6) AS q3, ROUND(q1 - (q3 - q1) * 1.5, 6) AS lower_fence,
  ROUND(q3 + (q3 - q1) * 1.5, 6) AS upper_fence, COUNT(v) AS n,
  CAST(SUM(CASE WHEN v < q1 - (q3 - q1) * 1.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_below,
  CAST(SUM(CASE WHEN v > q3 + (q3 - q1) * 1.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_above
FROM x, qq GROUP BY q1, q3"""))
def iqr_outliers(spark, d):
    return quality.iqr_outliers(T.items(spark, d), "price", exact=True)


@register("duplication_rate", f"""
WITH g AS (SELECT lang, text, COUNT(*) AS k FROM documents GROUP BY lang, text)
SELECT CAST(SUM(k) AS BIGINT) AS total_rows, COUNT(*) AS distinct_rows,
  CAST(SUM(k) - COUNT(*) AS BIGINT) AS duplicate_rows,
  {ratio('SUM(k) - COUNT(*)', 'SUM(k)', 2, pct=True)} AS duplicate_pct FROM g""")
def duplication_rate(spark, d):
    return quality.duplication_rate(T.table(spark, d, "documents").select("lang", "text"))


_FILES_SQL = """, f AS (SELECT 'load_' || (event_id % 8) AS file, event_id, event_type, value, ts FROM events),
all_files AS (SELECT * FROM f UNION ALL SELECT 'again_3', event_id, event_type, value, ts FROM f WHERE file = 'load_3'
  UNION ALL SELECT 'edit_5', event_id, event_type, value, CASE WHEN event_id = (SELECT MIN(event_id) FROM f WHERE file = 'load_5')
    THEN ts + INTERVAL 1 MICROSECOND ELSE ts END FROM f WHERE file = 'load_5'
  UNION ALL SELECT 'twice_6', event_id, event_type, value, ts FROM f WHERE file = 'load_6'
  UNION ALL SELECT 'twice_6', event_id, event_type, value, ts FROM f WHERE file = 'load_6')"""


@register("reloaded_files", q(_FILES_SQL + """
, rows_of AS (SELECT file, COUNT(*) AS n_rows, list((event_id, event_type, value, ts) ORDER BY event_id, event_type, value, ts) AS content
  FROM all_files GROUP BY file),
firsts AS (SELECT content, MIN(file) AS same_as FROM rows_of GROUP BY content HAVING COUNT(*) > 1)
SELECT file, same_as, n_rows FROM rows_of JOIN firsts USING (content) WHERE file <> same_as"""))
def reloaded_files(spark, d):
    """Planted: one file loaded again under another name; one with a microsecond changed and one doubled are no reloads."""
    f = T.table(spark, d, "events").select(F.concat(F.lit("load_"), F.col("event_id") % 8).alias("file"),
                                           "event_id", "event_type", "value", "ts")
    low = f.where("file = 'load_5'").agg(F.min("event_id")).scalar()
    again = f.where("file = 'load_3'").withColumn("file", F.lit("again_3"))
    edit = f.where("file = 'load_5'").withColumn("file", F.lit("edit_5")).withColumn(
        "ts", F.when(F.col("event_id") == low, F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).otherwise(F.col("ts")))
    six = f.where("file = 'load_6'").withColumn("file", F.lit("twice_6"))
    return quality.reloaded_files(f.unionByName(again).unionByName(edit).unionByName(six).unionByName(six), "file")


# planted: every 40th row again, one microsecond later; every 50th again as it is; zeros of both signs
_ODD_SQL = """WITH x AS (SELECT event_type, ts, CASE WHEN event_id % 10 = 0 THEN 0.0 ELSE value END AS value FROM events
  UNION ALL SELECT event_type, ts + INTERVAL 1 MICROSECOND, value FROM events WHERE event_id % 40 = 0
  UNION ALL SELECT event_type, ts, CASE WHEN event_id % 10 = 0 THEN 0.0 ELSE value END FROM events WHERE event_id % 50 = 0),
g AS (SELECT event_type, ts, value, COUNT(*) AS n_copies FROM x GROUP BY event_type, ts, value)
"""


def _odd_events(spark, d):
    e = T.table(spark, d, "events")
    zero = lambda sign: F.when(F.col("event_id") % 10 == 0, F.lit(sign * 0.0)).otherwise(F.col("value")).alias("value")
    return e.select("event_type", "ts", zero(1)).unionByName(
        e.where("event_id % 40 = 0").select("event_type", (F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).alias("ts"), "value")).unionByName(
        e.where("event_id % 50 = 0").select("event_type", "ts", zero(-1)))


@register("duplicate_events", _ODD_SQL + "SELECT * FROM g WHERE n_copies > 1")
def duplicate_events(spark, d):
    """Rows that differ by a microsecond are two, 0.0 and -0.0 are one."""
    return quality.duplicate_rows(_odd_events(spark, d)).withColumn("value", F.col("value") + F.lit(0.0))


@register("duplication_rate_events", _ODD_SQL + f"""
SELECT CAST(SUM(n_copies) AS BIGINT) AS total_rows, COUNT(*) AS distinct_rows,
  CAST(SUM(n_copies) - COUNT(*) AS BIGINT) AS duplicate_rows,
  {ratio('SUM(n_copies) - COUNT(*)', 'SUM(n_copies)', 2, pct=True)} AS duplicate_pct FROM g""")
def duplication_rate_events(spark, d):
    return quality.duplication_rate(_odd_events(spark, d))


@register("freshness", q(f"""
SELECT MIN(tap_ts) AS earliest, MAX(tap_ts) AS latest,
  CAST(SUM(CASE WHEN tap_ts > TIMESTAMP '{TAPS_AS_OF}' THEN 1 ELSE 0 END) AS BIGINT) AS future_rows,
  CAST(datediff('day', MAX(tap_ts), TIMESTAMP '{TAPS_AS_OF}') AS BIGINT) AS days_since_last FROM c_taps"""))
def freshness(spark, d):
    return quality.freshness(T.taps(spark, d), "tap_ts", _ts(TAPS_AS_OF))


@register("per_key_cardinality", q(f"""
, per AS (SELECT customer_id, COUNT(*) AS n, COUNT(DISTINCT status) AS v FROM c_orders GROUP BY customer_id)
SELECT COUNT(*) AS n_keys, CAST(SUM(CASE WHEN v > 1 THEN 1 ELSE 0 END) AS BIGINT) AS keys_with_multiple,
  MIN(n) AS min_per_key, MAX(n) AS max_per_key, {avg_exact('n', 0, 4)} AS avg_per_key FROM per"""))
def per_key_cardinality(spark, d):
    return quality.per_key_cardinality(T.orders(spark, d), "customer_id", "status")


@register("volume", q(f"""
SELECT {month('purchase_ts')} AS period, status, COUNT(*) AS n_rows FROM c_orders GROUP BY 1, 2"""))
def volume(spark, d):
    return quality.volume(T.orders(spark, d), "purchase_ts", "month", ["status"])


_VIOLATION_SQL = {"shipped_before_order": "shipped_ts < purchase_ts",
                  "discount_exceeds_tax": "discount > tax",
                  "non_positive_price": "price <= 0",
                  "unknown_return_flag": "return_flag NOT IN ('A', 'N', 'R')"}


@register("rule_violations", q(_LINES_SQL + _rules_sql(_VIOLATION_SQL, "ln", "n_violations")))
def rule_violations(spark, d):
    c = F.col
    return quality.rule_violations(_lines(spark, d), {
        "shipped_before_order": c("shipped_ts") < c("purchase_ts"),
        "discount_exceeds_tax": c("discount") > c("tax"),
        "non_positive_price": c("price") <= 0,
        "unknown_return_flag": ~c("return_flag").isin("A", "N", "R")})


_CHAIN = ["purchase_ts", "first_ship_ts", "last_ship_ts"]


@register("sequence_validity", q("""
, s AS (SELECT o.purchase_ts, MIN(i.shipped_ts) AS first_ship_ts, MAX(i.shipped_ts) AS last_ship_ts
  FROM c_orders o LEFT JOIN c_items i ON o.order_id = i.order_id GROUP BY o.order_id, o.purchase_ts)
""" + _union([f"""SELECT '{a}->{b}' AS step, CAST(SUM(CASE WHEN {a} <= {b} THEN 1 ELSE 0 END) AS BIGINT) AS n_valid,
  CAST(SUM(CASE WHEN {a} > {b} THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid,
  CAST(SUM(CASE WHEN {a} IS NULL OR {b} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM s"""
                for a, b in zip(_CHAIN, _CHAIN[1:])] + [
    """SELECT 'chain' AS step, CAST(SUM(CASE WHEN purchase_ts <= first_ship_ts AND first_ship_ts <= last_ship_ts
  THEN 1 ELSE 0 END) AS BIGINT) AS n_valid, COUNT(*) - CAST(SUM(CASE WHEN purchase_ts <= first_ship_ts
  AND first_ship_ts <= last_ship_ts THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid, CAST(NULL AS BIGINT) AS n_missing
  FROM s"""])))
def sequence_validity(spark, d):
    o = T.orders(spark, d).select("order_id", "purchase_ts")
    s = T.items(spark, d).groupBy("order_id").agg(F.min("shipped_ts").alias("first_ship_ts"),
                                                  F.max("shipped_ts").alias("last_ship_ts"))
    return quality.sequence_validity(o.join(s, "order_id", "left"), _CHAIN)


@register("total_consistency", q("""
, p AS (SELECT order_id, SUM(price + freight) AS parts FROM c_items GROUP BY order_id),
t AS (SELECT order_id, CASE WHEN order_id % 3 = 0 THEN order_total ELSE parts END AS total
      FROM c_orders LEFT JOIN p USING (order_id) WHERE order_id % 11 <> 0),
j AS (SELECT t.order_id AS parent, p.order_id AS part, ABS(t.total - p.parts) AS diff FROM t FULL JOIN p ON t.order_id = p.order_id)
SELECT COUNT(*) AS n_keys, COUNT(*) FILTER (diff <= 0.01) AS n_consistent, COUNT(*) FILTER (diff > 0.01) AS n_inconsistent,
  COUNT(*) FILTER (part IS NULL) AS n_without_parts, COUNT(*) FILTER (parent IS NULL) AS n_without_parent,
  CAST(MAX(diff) AS DECIMAL(18,2)) AS max_abs_diff FROM j"""))
def total_consistency(spark, d):
    # planted: two thirds of the orders carry the sum of their lines, and one in eleven is missing
    items = T.items(spark, d).withColumn("line_total", F.col("price") + F.col("freight"))
    sums = items.groupBy("order_id").agg(F.sum("line_total").alias("parts"))
    orders = T.orders(spark, d).where(F.col("order_id") % 11 != 0).join(sums, "order_id", "left").select(
        "order_id", F.when(F.col("order_id") % 3 == 0, F.col("order_total")).otherwise(F.col("parts")).alias("total"))
    out = quality.total_consistency(orders, items, "order_id", "total", "line_total", 0.01)
    return out.withColumn("max_abs_diff", F.col("max_abs_diff").cast(MONEY))


@register("status_sum_check", q("""
SELECT total_rows, sum_of_parts, CASE WHEN total_rows = sum_of_parts THEN 'Match' ELSE 'Mismatch' END AS result
FROM (SELECT COUNT(*) AS total_rows, SUM(CASE WHEN status IN ('F', 'O') THEN 1 ELSE 0 END)::BIGINT AS sum_of_parts FROM c_orders)
UNION ALL
SELECT total_rows, sum_of_parts, CASE WHEN total_rows = sum_of_parts THEN 'Match' ELSE 'Mismatch' END AS result
FROM (SELECT COUNT(*) AS total_rows, SUM(CASE WHEN status IN ('F', 'O', 'P') THEN 1 ELSE 0 END)::BIGINT AS sum_of_parts FROM c_orders)"""))
def status_sum_check(spark, d):
    """Counts of two and of three statuses against all orders."""
    o = T.orders(spark, d)
    return quality.parts_match_total(o, "status", ["F", "O"]).unionByName(
        quality.parts_match_total(o, "status", ["F", "O", "P"]))


@register("duplication_rate_by_lang", f"""
WITH g AS (SELECT lang, text, COUNT(*) AS k FROM documents GROUP BY lang, text)
SELECT lang, CAST(SUM(k) AS BIGINT) AS total_rows, COUNT(*) AS distinct_rows,
  CAST(SUM(k) - COUNT(*) AS BIGINT) AS duplicate_rows,
  {ratio('SUM(k) - COUNT(*)', 'SUM(k)', 2, pct=True)} AS duplicate_pct FROM g GROUP BY lang""")
def duplication_rate_by_lang(spark, d):
    return quality.duplication_rate(T.table(spark, d, "documents").select("lang", "text"), by=["lang"])


@register("empty_periods", q("""
, kept AS (SELECT CAST(purchase_ts AS DATE) AS d FROM c_orders WHERE dayofweek(purchase_ts) NOT IN (0, 3)),
ends AS (SELECT MIN(d) AS lo, MAX(d) AS hi FROM kept)
SELECT CAST(g AS DATE) AS period, 0::BIGINT AS n_rows
FROM ends, generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) AS t(g)
WHERE CAST(g AS DATE) NOT IN (SELECT d FROM kept)"""))
def empty_periods(spark, d):
    # planted: no orders on Sundays and Wednesdays
    o = T.orders(spark, d).where(~F.dayofweek("purchase_ts").isin(1, 4))
    return quality.empty_periods(o, "purchase_ts")


@register("run_suite", q("""
SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
SELECT 'not_null' AS test, 'order_id' AS target, CAST(SUM(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM c_items
UNION ALL SELECT 'not_null', 'product_id', CAST(SUM(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM c_items
UNION ALL SELECT 'expression_is_true', 'positive_price', CAST(SUM(CASE WHEN NOT COALESCE(price > 0, FALSE) THEN 1 ELSE 0 END) AS BIGINT) FROM c_items
UNION ALL SELECT 'expression_is_true', 'discount_in_range', CAST(SUM(CASE WHEN NOT COALESCE(discount BETWEEN 0 AND 0.1, FALSE) THEN 1 ELSE 0 END) AS BIGINT) FROM c_items
UNION ALL SELECT 'unique', 'order_id,line_no', CAST(COALESCE(SUM(k), 0) AS BIGINT) FROM
  (SELECT COUNT(*) AS k FROM c_items GROUP BY order_id, line_no HAVING COUNT(*) > 1))"""))
def run_suite(spark, d):
    return quality.run_suite(
        T.items(spark, d), not_null=["order_id", "product_id"], unique=[["order_id", "line_no"]],
        expressions={"positive_price": F.col("price") > 0,
                     "discount_in_range": F.col("discount").between(F.lit(0), F.lit(0.1).cast(MONEY))})


@register("pattern_check", q(_union([f"""SELECT '{c}' AS column_name, COUNT({c}) AS n_checked,
  CAST(SUM(CASE WHEN {c} IS NOT NULL AND NOT regexp_matches({c}, '{p}') THEN 1 ELSE 0 END) AS BIGINT) AS n_invalid
  FROM (SELECT CASE WHEN customer_id % 50 = 0 THEN '?' || {c} WHEN customer_id % 51 = 0 THEN NULL ELSE {c} END AS {c}
        FROM c_customers)""" for c, p in PATTERNS.items()])))
def pattern_check(spark, d):
    # planted: some values begin with a question mark, some are NULL
    bad = T.customers(spark, d).select(*[
        F.when(F.col("customer_id") % 50 == 0, F.concat(F.lit("?"), F.col(c)))
        .when(F.col("customer_id") % 51 != 0, F.col(c)).alias(c) for c in PATTERNS])
    return quality.pattern_check(bad, PATTERNS)


@register("castability", _union([f"""SELECT '{c}' AS column_name, '{t}' AS target_type,
  CAST(SUM(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS {t.upper()}) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_uncastable
  FROM (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice
        FROM orders)""" for c, t in CASTS.items()]))
def castability(spark, d):
    return quality.castability(bronze_orders(spark, d), CASTS)


@register("distinct_approx", None)
def distinct_approx(spark, d):
    return quality.distinct_report(T.items(spark, d), DISTINCT_COLS, approx=True)


@register("distinct_approx_within", _union([f"SELECT '{c}' AS column_name, TRUE AS within" for c in DISTINCT_COLS]))
def distinct_approx_within(spark, d):
    """Is each sketch count within three times its stated deviation of the exact count?"""
    i = T.items(spark, d)
    near = quality.distinct_report(i, DISTINCT_COLS, approx=True, rsd=0.02).withColumnRenamed("n_distinct", "_near")
    return quality.distinct_report(i, DISTINCT_COLS).join(near, "column_name").select(
        "column_name", (F.abs(F.col("_near") - F.col("n_distinct")) <= 0.06 * F.col("n_distinct")).alias("within"))


EXPECTED_ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
                   "o_totalprice": "decimal(18,2)", "o_orderdate": "date", "o_comment": "string"}


# DuckDB type names of the parquet columns, spelled as Spark's simpleString
_SPARK_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
  WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date'
  WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(data_type) END"""

_EXPECTED_SQL = ", ".join(f"('{c}', '{t}')" for c, t in EXPECTED_ORDERS.items())


@register("schema_drift", f"""
WITH e(column_name, expected_type) AS (VALUES {_EXPECTED_SQL}),
a AS (SELECT column_name, {_SPARK_TYPE} AS actual_type FROM information_schema.columns WHERE table_name = 'orders')
SELECT COALESCE(e.column_name, a.column_name) AS column_name, e.expected_type, a.actual_type,
  CASE WHEN a.column_name IS NULL THEN 'missing' WHEN e.column_name IS NULL THEN 'unexpected'
       WHEN e.expected_type = a.actual_type THEN 'ok' ELSE 'type_mismatch' END AS issue
FROM e FULL OUTER JOIN a ON e.column_name = a.column_name""")
def schema_drift(spark, d):
    return quality.schema_drift(T.table(spark, d, "orders"), EXPECTED_ORDERS)


@register("schema_report", f"""
SELECT column_name, {_SPARK_TYPE} AS data_type, CAST(ordinal_position AS INTEGER) AS ordinal
FROM information_schema.columns WHERE table_name = 'lineitem'""")
def schema_report(spark, d):
    return quality.schema_report(T.table(spark, d, "lineitem"))


@register("duration_hours", q("""
, s AS (SELECT o.purchase_ts, MIN(i.shipped_ts) AS first_ship_ts FROM c_orders o
  JOIN c_items i ON o.order_id = i.order_id GROUP BY o.order_id, o.purchase_ts),
x AS (SELECT date_diff('second', purchase_ts, first_ship_ts) AS sec FROM s)
SELECT COUNT(sec) AS n,
  """ + half_up("MIN(sec)", "3600", 2) + """ AS min_hours,
  """ + half_up("MAX(sec)", "3600", 2) + """ AS max_hours,
  """ + half_up("SUM(sec)", "COUNT(sec) * 3600", 2) + """ AS avg_hours FROM x"""))
def duration_hours(spark, d):
    o = T.orders(spark, d).select("order_id", "purchase_ts")
    s = T.items(spark, d).groupBy("order_id").agg(F.min("shipped_ts").alias("first_ship_ts"))
    return quality.duration_hours(o.join(s, "order_id"), "purchase_ts", "first_ship_ts")


@register("volume_vs_expected", q("""
, v AS (SELECT CAST(tap_ts AS DATE) AS period, COUNT(*) AS n_rows FROM c_taps GROUP BY 1),
e AS (SELECT """ + half_up("SUM(n_rows)", "COUNT(*)", 2) + """ AS expected FROM v)
SELECT period, n_rows, expected,
  """ + half_up("CAST((n_rows - expected) * 10000 AS HUGEINT)", "CAST(expected * 100 AS HUGEINT)", 2) + """ AS deviation_pct
FROM v, e"""))
def volume_vs_expected(spark, d):
    return quality.volume(T.taps(spark, d), "tap_ts", "day", expected="mean")


# ------------------------------------------- generic checks on the other tables

ROLES = ("user", "assistant", "system")
URL_PATTERN = r"^https?://[a-z0-9.-]+\.(com|net|org)(/|$)"
EMBED_DIM = 64


@register("conversation_keys", """
WITH k AS (SELECT conv_id, turn, COUNT(*) AS c FROM conversations GROUP BY conv_id, turn)
SELECT CAST(SUM(c) AS BIGINT) AS total_rows, COUNT(*) AS unique_keys,
  CAST(SUM(CASE WHEN c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys,
  CAST(SUM(CASE WHEN c > 1 THEN c ELSE 0 END) AS BIGINT) AS rows_in_duplicates, MAX(c) AS max_per_key FROM k""")
def conversation_keys(spark, d):
    return quality.key_uniqueness(T.table(spark, d, "conversations"), ["conv_id", "turn"])


@register("conversation_roles", f"""
SELECT role AS value, COUNT(*) AS n, {ratio('COUNT(*)', 'SUM(COUNT(*)) OVER ()', 2, pct=True)} AS pct,
  COALESCE(role IN ({", ".join(f"'{r}'" for r in ROLES)}), FALSE) AS is_allowed
FROM conversations GROUP BY role""")
def conversation_roles(spark, d):
    return quality.domain_check(T.table(spark, d, "conversations"), "role", ROLES)


@register("page_url_patterns", f"""
SELECT 'url' AS column_name, COUNT(url) AS n_checked,
  CAST(SUM(CASE WHEN url IS NOT NULL AND NOT regexp_matches(url, '{URL_PATTERN}') THEN 1 ELSE 0 END) AS BIGINT)
  AS n_invalid FROM (SELECT CASE WHEN page_id % 10 = 0 THEN substr(url, 6) ELSE url END AS url FROM pages)""")
def page_url_patterns(spark, d):
    # planted: every tenth URL lost its first five characters
    url = F.when(F.col("page_id") % 10 == 0, F.expr("substr(url, 6)")).otherwise(F.col("url"))
    return quality.pattern_check(T.table(spark, d, "pages").select(url.alias("url")), {"url": URL_PATTERN})


_CORPUS = (("conversation_text", "conversations", "text"), ("benchmark_text", "benchmark", "text"),
           ("page_html", "pages", "html"))


@register("corpus_text_lengths", _union([f"""SELECT '{label}' AS column_name,
  CAST(MIN(length({c})) AS BIGINT) AS min_len, CAST(MAX(length({c})) AS BIGINT) AS max_len,
  {avg_exact(f'length({c})', 0, 2)} AS avg_len FROM {t}""" for label, t, c in _CORPUS]))
def corpus_text_lengths(spark, d):
    out = None
    for label, t, c in _CORPUS:
        r = quality.string_lengths(T.table(spark, d, t).select(F.col(c).alias(label)), [label])
        out = r if out is None else out.unionByName(r)
    return out


@register("embedding_checks", _union([f"""SELECT '{n}' AS rule, COUNT(*) AS n_rows,
  CAST(SUM(CASE WHEN {p} THEN 1 ELSE 0 END) AS BIGINT) AS n_matching FROM (
  SELECT CASE WHEN vec_id % 20 = 0 THEN NULL WHEN vec_id % 21 = 0 THEN embedding[:{EMBED_DIM - 1}] ELSE embedding END AS embedding,
    CASE WHEN vec_id % 22 <> 0 THEN label END AS label FROM embeddings)""" for n, p in (
    ("wrong_dimension", f"len(embedding) <> {EMBED_DIM}"), ("null_vector", "embedding IS NULL"),
    ("unlabelled", "label IS NULL"))]))
def embedding_checks(spark, d):
    # planted: vectors that are missing or too short, and missing labels
    e = T.table(spark, d, "embeddings").select(
        F.when(F.col("vec_id") % 21 == 0, F.slice("embedding", 1, EMBED_DIM - 1)).otherwise(F.col("embedding")).alias("v"),
        "vec_id", F.when(F.col("vec_id") % 22 != 0, F.col("label")).alias("label"))
    e = e.select(F.when(F.col("vec_id") % 20 != 0, F.col("v")).alias("embedding"), "label")
    return quality.rule_counts(e, {"wrong_dimension": F.size("embedding") != EMBED_DIM,
                                   "null_vector": F.col("embedding").isNull(),
                                   "unlabelled": F.col("label").isNull()})


_BOX = (-9.0, -18.0, 9.0, 18.0)  # south, west, north, east


@register("geo_check", f"""
WITH raw AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 90 AS la, CAST(embedding[2] AS DOUBLE) * 180 AS lo FROM embeddings),
p AS (SELECT CASE WHEN vec_id % 10 = 0 THEN NULL WHEN vec_id % 11 = 0 THEN 0 WHEN vec_id % 13 = 0 THEN 17 WHEN vec_id % 17 = 0 THEN la + 200
  ELSE la END AS la, CASE WHEN vec_id % 13 = 0 THEN 1 ELSE lo END AS lo FROM raw)
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (la IS NULL OR lo IS NULL) AS n_missing, COUNT(*) FILTER (la = 0 OR lo = 0) AS n_zero,
  COUNT(*) FILTER (abs(la) > 90 OR abs(lo) > 180) AS n_out_of_range,
  COUNT(*) FILTER (la IS NOT NULL AND lo IS NOT NULL AND NOT (la BETWEEN {_BOX[0]} AND {_BOX[2]} AND lo BETWEEN {_BOX[1]} AND {_BOX[3]})) AS n_outside_box,
  COUNT(*) FILTER (lo BETWEEN {_BOX[0]} AND {_BOX[2]} AND la BETWEEN {_BOX[1]} AND {_BOX[3]}
    AND NOT (la BETWEEN {_BOX[0]} AND {_BOX[2]} AND lo BETWEEN {_BOX[1]} AND {_BOX[3]})) AS n_swapped FROM p""")
def geo_check(spark, d):
    """Coordinates from two vector components. Planted: missing and zero latitudes, swapped pairs, latitudes out of range."""
    e, by = T.table(spark, d, "embeddings"), F.col("vec_id")
    la, lo = F.get("embedding", F.lit(0)).cast("double") * 90, F.get("embedding", F.lit(1)).cast("double") * 180
    points = e.select(F.when(by % 10 == 0, None).when(by % 11 == 0, 0.0).when(by % 13 == 0, 17.0).when(by % 17 == 0, la + 200).otherwise(la).alias("la"),
                      F.when(by % 13 == 0, 1.0).otherwise(lo).alias("lo"))
    return quality.geo_check(points, "la", "lo", _BOX)


# corners of a zone around its centre (degrees east, north): an arrow, so that its bounding box holds points outside
_ARROW = ((-8.0, -4.0), (8.0, -4.0), (8.0, 4.0), (0.0, -1.0), (-8.0, 4.0))
_ARROW_SQL = ", ".join(f"({i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for i, (x, y) in enumerate(_ARROW))


def _zones(spark, d):
    """One zone a nation, five by five; those of neighbouring regions overlap."""
    east, north = (F.col("n_nationkey") % 5 - 2) * 18.0 + F.col("n_regionkey"), (F.floor(F.col("n_nationkey") / 5) - 2) * 9.0
    ring = F.array(*[F.struct((east + x).alias("lon"), (north + y).alias("lat")) for x, y in _ARROW])
    return T.table(spark, d, "nation").select(F.col("n_name").alias("zone"), ring.alias("ring"))


@register("point_zones", f"""
WITH raw AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 90 AS a, CAST(embedding[2] AS DOUBLE) * 180 AS o FROM embeddings),
p AS (SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN NULL WHEN vec_id % 13 = 0 THEN o WHEN vec_id % 17 = 0 THEN a + 200 ELSE a END AS la,
  CASE WHEN vec_id % 13 = 0 THEN a ELSE o END AS lo FROM raw),
corners AS (SELECT n_name AS zone, i, (n_nationkey % 5 - 2) * CAST(18 AS DOUBLE) + n_regionkey + x AS x1,
  (n_nationkey // 5 - 2) * CAST(9 AS DOUBLE) + y AS y1 FROM nation, (VALUES {_ARROW_SQL}) AS v(i, x, y)),
edges AS (SELECT zone, x1, y1, LEAD(x1, 1, f_x) OVER (PARTITION BY zone ORDER BY i) AS x2, LEAD(y1, 1, f_y) OVER (PARTITION BY zone ORDER BY i) AS y2
  FROM (SELECT *, FIRST_VALUE(x1) OVER (PARTITION BY zone ORDER BY i) AS f_x, FIRST_VALUE(y1) OVER (PARTITION BY zone ORDER BY i) AS f_y FROM corners)),
asked AS (SELECT vec_id, FALSE AS turned, la, lo FROM p UNION ALL SELECT vec_id, TRUE, lo, la FROM p),
hits AS (SELECT vec_id, turned, zone FROM asked JOIN edges ON (y1 > la) <> (y2 > la) AND lo < (x2 - x1) * (la - y1) / (y2 - y1) + x1
  WHERE abs(la) <= 90 AND abs(lo) <= 180 GROUP BY vec_id, turned, zone HAVING COUNT(*) % 2 = 1),
met AS (SELECT vec_id, COUNT(*) FILTER (NOT turned) AS n, MIN(zone) FILTER (NOT turned) AS z, MIN(zone) FILTER (turned) AS t FROM hits GROUP BY vec_id)
SELECT p.vec_id, CASE WHEN la IS NULL OR lo IS NULL OR isnan(la) OR isnan(lo) THEN 'missing' WHEN n > 0 THEN 'inside' WHEN t IS NOT NULL THEN 'swapped'
  WHEN abs(la) > 90 OR abs(lo) > 180 THEN 'out of range' ELSE 'outside' END AS status, COALESCE(n, 0) AS n_zones, COALESCE(z, t) AS zone
FROM p LEFT JOIN met ON p.vec_id = met.vec_id""")
def point_zones(spark, d):
    """Zones of the points that two vector components give. Planted: missing, swapped and out of range coordinates."""
    by = F.col("vec_id")
    a, o = F.get("embedding", F.lit(0)).cast("double") * 90, F.get("embedding", F.lit(1)).cast("double") * 180
    points = T.table(spark, d, "embeddings").select(
        "vec_id", F.when(by % 10 == 0, None).when(by % 13 == 0, o).when(by % 17 == 0, a + 200).otherwise(a).alias("la"),
        F.when(by % 13 == 0, a).otherwise(o).alias("lo"))
    return zones.place_points(points, "vec_id", "la", "lo", _zones(spark, d))


@register("table_info", """
SELECT (SELECT COUNT(*) FROM orders) AS total_rows,
  (SELECT COUNT(*) FROM information_schema.columns WHERE table_name = 'orders') AS total_columns,
  (SELECT string_agg(column_name, ', ' ORDER BY ordinal_position) FROM information_schema.columns
   WHERE table_name = 'orders') AS column_names""")
def table_info(spark, d):
    return quality.table_info(T.table(spark, d, "orders"))


@register("delivery_performance", q(f"""
, s AS (SELECT order_id, MAX(shipped_ts) AS delivered_ts FROM c_items GROUP BY order_id),
d AS (SELECT s.delivered_ts, o.purchase_ts + INTERVAL 30 DAY AS estimated_ts FROM c_orders o
  JOIN s ON o.order_id = s.order_id)
SELECT COUNT(*) AS total_delivered,
  CAST(SUM(CASE WHEN delivered_ts <= estimated_ts THEN 1 ELSE 0 END) AS BIGINT) AS on_time,
  CAST(SUM(CASE WHEN delivered_ts > estimated_ts THEN 1 ELSE 0 END) AS BIGINT) AS late,
  {avg_exact("datediff('day', estimated_ts, delivered_ts)", 0, 1)} AS avg_days_vs_estimate,
  {ratio("SUM(CASE WHEN delivered_ts <= estimated_ts THEN 1 ELSE 0 END)", "COUNT(*)", 2, pct=True)} AS on_time_pct
FROM d WHERE delivered_ts IS NOT NULL AND estimated_ts IS NOT NULL"""))
def delivery_performance(spark, d):
    st = sales.delivery_status(T.orders(spark, d), T.items(spark, d), 30)
    return quality.delivery_performance(st, "delivered_ts", "estimated_ts")


@register("duplicate_line_keys", q("""
SELECT order_id, line_no, COUNT(*) AS cnt FROM c_items GROUP BY order_id, line_no HAVING COUNT(*) > 1"""))
def duplicate_line_keys(spark, d):
    return quality.duplicate_keys(T.items(spark, d), ["order_id", "line_no"])
