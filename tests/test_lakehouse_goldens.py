"""Golden values of the literal lakehouse tables (five rows per bronze table)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.functions.columns import MONEY
from lakemart.operators import conform, relational, sales
from lakemart.operators.conform import Field

# The literal bronze rows of the reference workload (all text).
CUSTOMERS = [("C001", "Alice Smith", "alice.s@example.com", "New York"),
             ("C002", "Bob Johnson", "bob.j@example.com", "Los Angeles"),
             ("C003", "Charlie Brown", "charlie.b@example.com", "Chicago"),
             ("C004", "Diana Prince", "diana.p@example.com", "Miami"),
             ("C005", "Eve Adams", "eve.a@example.com", "Houston")]
PRODUCTS = [("P001", "Laptop", "Electronics", "1200.00"), ("P002", "Mouse", "Electronics", "25.00"),
            ("P003", "Keyboard", "Electronics", "50.00"), ("P004", "Monitor", "Electronics", "300.00"),
            ("P005", "Headphones", "Electronics", "80.00")]
ORDERS = [("O001", "C001", "2023-01-10", "Completed"), ("O002", "C002", "2023-01-11", "Pending"),
          ("O003", "C001", "2023-01-12", "Completed"), ("O004", "C003", "2023-01-13", "Shipped"),
          ("O005", "C004", "2023-01-14", "Completed")]
ITEMS = [("OI001", "O001", "P001", "1", "1200.00"), ("OI002", "O001", "P002", "2", "25.00"),
         ("OI003", "O002", "P003", "1", "75.00"), ("OI004", "O003", "P004", "1", "300.00"),
         ("OI005", "O004", "P005", "3", "50.00")]
PAYMENTS = [("PM001", "O001", "2023-01-10", "1250.00", "Credit Card"),
            ("PM002", "O003", "2023-01-12", "300.00", "Debit Card"),
            ("PM003", "O004", "2023-01-13", "150.00", "PayPal"),
            ("PM004", "O005", "2023-01-14", "500.00", "Credit Card"),
            ("PM005", "O002", "2023-01-11", "75.00", "Credit Card")]


@pytest.fixture(scope="module")
def silver(spark):
    s = lambda cols: ", ".join(f"{c} string" for c in cols)
    bc = spark.createDataFrame(CUSTOMERS, s(["customer_id", "customer_name", "email", "city"]))
    bp = spark.createDataFrame(PRODUCTS, s(["product_id", "product_name", "product_category", "price"]))
    bo = spark.createDataFrame(ORDERS, s(["order_id", "customer_id", "order_date", "status"]))
    bi = spark.createDataFrame(ITEMS, s(["order_item_id", "order_id", "product_id", "quantity", "unit_price"]))
    bpay = spark.createDataFrame(PAYMENTS, s(["payment_id", "order_id", "payment_date", "amount", "payment_method"]))
    customers = bc.select("customer_id", "customer_name", F.col("city").alias("state"))
    products = conform.conform(bp, [Field("product_id", "product_id"), Field("product_name", "product_name"),
                                    Field("category", "product_category"), Field("price", "price", "decimal(18,2)")])
    orders = conform.conform(bo, [Field("order_id", "order_id"), Field("customer_id", "customer_id"),
                                  Field("purchase_ts", "order_date", "timestamp_ntz", fmt="yyyy-MM-dd"),
                                  Field("status", "status")])
    items = conform.conform(bi, [Field("line_no", "order_item_id"), Field("order_id", "order_id"),
                                 Field("product_id", "product_id"), Field("quantity", "quantity", "int"),
                                 Field("price", "unit_price", "decimal(18,2)")])
    payments = conform.conform(bpay, [Field("payment_id", "payment_id"), Field("order_id", "order_id"),
                                      Field("payment_ts", "payment_date", "timestamp_ntz", fmt="yyyy-MM-dd"),
                                      Field("payment_value", "amount", "decimal(18,2)"),
                                      Field("payment_type", "payment_method")])
    return dict(customers=customers, products=products, orders=orders, items=items, payments=payments)


def test_details_and_gold(silver):
    det = sales.order_details(silver["orders"], silver["customers"], silver["items"], silver["products"],
                              silver["payments"])
    rows = det.collect()
    assert len(rows) == 5
    assert "O005" not in {r.order_id for r in rows}  # no items: dropped by the inner join
    o1 = {r.product_name: r.total_item_price for r in rows if r.order_id == "O001"}
    assert o1 == {"Laptop": Decimal("1200.00"), "Mouse": Decimal("50.00")}
    gold = sales.monthly_sales_by_category(det).collect()
    assert [(str(g.sales_month), g.category, g.total_sales, g.total_orders, g.unique_customers) for g in gold] == \
        [("2023-01-01", "Electronics", Decimal("1775.00"), 4, 3)]


def test_payments_total_and_spend_at_order_grain(silver):
    assert silver["payments"].agg(F.sum("payment_value")).first()[0] == Decimal("2275.00")
    paid = silver["orders"].join(sales.order_payments(silver["payments"]), "order_id")
    spend = {r.customer_id: r.total_spend for r in
             sales.customer_spend(paid, amount="payment_amount").collect()}
    assert spend["C001"] == Decimal("1550.00")  # not 2800: one payment per order, not per item


def test_price_rules(silver):
    p = silver["products"]
    assert p.where(F.col("price") > 100).count() == 2
    bands = {r.product_id: r.price_band for r in sales.price_band(p, (50, 100)).collect()}
    assert bands == {"P001": "High", "P004": "High", "P005": "Medium", "P002": "Low", "P003": "Low"}
    assert [r.product_id for r in sales.above_average(p, "price").collect()] == ["P001"]


def test_pairs_and_repeats(silver):
    c = silver["customers"]
    same_city = relational.pair_counts_within(c, "state", "customer_id").agg(F.sum("pairs")).first()[0]
    assert same_city == 0
    o = silver["orders"]
    c001 = relational.pair_counts_within(o, "customer_id", "order_id").where(F.col("customer_id") == "C001").first()
    assert (c001.members, c001.pairs) == (2, 1)  # O001 with O003


def test_anti_semi_and_status(silver):
    o, i = silver["orders"], silver["items"]
    assert [r.order_id for r in relational.orders_without(o, i, "order_id").collect()] == ["O005"]
    assert relational.orders_with(o, i, "order_id").count() == 4
    share = {r.status: (r.n, r.pct) for r in relational.share_of_total(o, "status").collect()}
    assert share["Completed"] == (3, Decimal("60.0000"))


def test_conform_report_mode(spark):
    df = spark.createDataFrame([("1", "2023-01-10"), ("x", "10/01/2023"), (None, None)], "a string, d string")
    out = conform.conform(df, [Field("a", "a", "int"), Field("d", "d", "date")], on_error="report").collect()
    assert out[0]._conform_errors == [] and out[1]._conform_errors == ["a", "d"] and out[2]._conform_errors == []
    with pytest.raises(Exception):
        conform.conform(df, [Field("a", "a", "int")], on_error="raise").collect()


def test_null_tokens_and_canonical(spark):
    df = spark.createDataFrame([(" n/a ",), ("TBC",), ("Birmigham",), ("london",)], "city string")
    out = conform.canonicalise(conform.null_tokens(df, ["city"]), "city",
                               {"birmigham": "Birmingham", "london": "London"})
    assert [r.city for r in out.collect()] == [None, None, "Birmingham", "London"]


def test_money_type(silver):
    assert dict(silver["items"].dtypes)["price"] == "decimal(18,2)"
    assert MONEY.simpleString() == "decimal(18,2)"


def test_monthly_sales_approx_close_to_exact(spark):
    from lakemart.plans import tables as T
    d = "/root/testdata/sf0.01"
    det = sales.order_details(T.orders(spark, d), T.customers(spark, d), T.items(spark, d), T.products(spark, d),
                              line_total="price")
    exact = {(r.sales_month, r.category): r for r in sales.monthly_sales_by_category(det).collect()}
    approx = {(r.sales_month, r.category): r for r in sales.monthly_sales_by_category(det, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for k, e in exact.items():
        a = approx[k]
        assert a.total_sales == e.total_sales
        assert abs(a.total_orders - e.total_orders) <= max(2, 0.08 * e.total_orders)
        assert abs(a.unique_customers - e.unique_customers) <= max(2, 0.08 * e.unique_customers)


def test_details_and_monthly_sales_keep_tasks_small(spark, monkeypatch):
    """However few the shuffle partitions, no task holds more than its share of the lines; the rows are the same."""
    from lakemart.operators import relational
    n = 1200
    orders = spark.range(n // 2).selectExpr(
        "id AS order_id", "id % 37 AS customer_id", "'F' AS status",
        "TIMESTAMP_NTZ'2024-01-15 00:00:00' + make_dt_interval(CAST(id % 90 AS INT)) AS purchase_ts")
    customers = spark.range(37).selectExpr("id AS customer_id", "concat('c', id) AS customer_name")
    items = spark.range(n).selectExpr(
        "id DIV 2 AS order_id", "CAST(id % 2 AS INT) AS line_no", "id % 23 AS product_id", "2 AS quantity",
        "CAST(id % 7 AS DECIMAL(18,2)) AS price")
    products = spark.range(23).selectExpr("id AS product_id", "concat('p', id) AS product_name", "concat('k', id % 3) AS category")
    plain = sales.order_details(orders, customers, items, products)
    want, want_gold = sorted(plain.collect()), sorted(sales.monthly_sales_by_category(plain).collect())
    monkeypatch.setattr(relational, "ROWS_PER_TASK", 60)
    conf = {"spark.sql.shuffle.partitions": "2", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # as for large tables
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        det = sales.order_details(orders, customers, items, products)
        assert det.columns == plain.columns and sorted(det.collect()) == want
        assert max(r["count"] for r in det.groupBy(F.spark_partition_id()).count().collect()) <= 4 * 60
        gold = sales.monthly_sales_by_category(det, lines=n)
        assert sorted(gold.collect()) == want_gold
        dealt = [line for line in gold._jdf.queryExecution().toString().splitlines() if "REPARTITION_BY_NUM" in line]
        assert any("customer_id" in line and ", 20)" in line for line in dealt)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_few_rows_leave_the_tasks_to_spark():
    from lakemart.operators.relational import LEAST_TASKS, ROWS_PER_TASK, task_count
    few = ROWS_PER_TASK * (LEAST_TASKS - 1)
    assert [task_count(n) for n in (0, few, few + 1, 60 * ROWS_PER_TASK + 1)] == [None, None, LEAST_TASKS, 61]
