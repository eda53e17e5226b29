"""SCD 1/2/3 and star-schema goldens."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.operators import merge, star
from lakemart.operators.ranking import assign_keys

# The SCD source rows and the change of the reference scenario.
SOURCE = [("C001", "Alice Smith", "North"), ("C002", "Bob Johnson", "East"), ("C003", "Carol White", "West"),
          ("C004", "David Green", "North"), ("C005", "Eve Black", "South"), ("C006", "Frank Miller", "East"),
          ("C007", "Grace Lee", "West"), ("C008", "Henry Wilson", "North"), ("C009", "Ivy Davis", "South"),
          ("C010", "Jack Brown", "East")]
KEYS = ["CustomerID"]


@pytest.fixture(scope="module")
def src(spark):
    return spark.createDataFrame([(a, b, c, date(2023, 1, 1)) for a, b, c in SOURCE],
                                 "CustomerID string, Name string, Region string, EffectiveDate date")


def change(spark, rows):
    return spark.createDataFrame(rows, "CustomerID string, Name string, Region string, EffectiveDate date")


def test_scd1(spark, src):
    t = merge.scd_init(src, 1, KEYS, "Region", "EffectiveDate")
    assert t.count() == 10
    out = merge.scd1_merge(t, change(spark, [("C001", "Alice Smith", "South", date(2023, 6, 15))]),
                           KEYS, ["Region"], "EffectiveDate")
    r = out.where("CustomerID = 'C001'").first()
    assert (r.Name, r.Region, r.LastUpdatedDate) == ("Alice Smith", "South", date(2023, 6, 15))
    assert out.count() == 10


def _scd2(spark, src):
    return merge.scd_init(src, 2, KEYS, "Region", "EffectiveDate", sk_col="SK")


def test_scd2_golden_and_invariants(spark, src):
    t = _scd2(spark, src)
    batch = change(spark, [("C001", "Alice Smith", "South", date(2023, 6, 15))])
    out = merge.scd2_apply(t, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK")
    rows = out.collect()
    assert len(rows) == 11
    c1 = sorted((r for r in rows if r.CustomerID == "C001"), key=lambda r: r.StartDate)
    assert (c1[0].EndDate, c1[0].IsCurrent) == (date(2023, 6, 14), False)
    assert (c1[1].Region, c1[1].StartDate, c1[1].IsCurrent, c1[1].SK) == ("South", date(2023, 6, 15), True, 11)
    assert out.where("IsCurrent").groupBy("CustomerID").count().where("count > 1").count() == 0
    # applying the same batch again changes nothing
    again = merge.scd2_apply(out, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_scd2_batch_cases(spark, src):
    t = _scd2(spark, src)
    batch = change(spark, [
        ("C002", "Bob Johnson", "West", date(2023, 3, 1)),   # two changes to one key
        ("C002", "Bob Johnson", "North", date(2023, 5, 1)),
        ("C003", "Carol White", "West", date(2023, 3, 1)),   # unchanged: no new row
        ("C004", "David Green", "East", date(2022, 12, 1)),  # older than current start: rejected
        ("C011", "New Person", "East", date(2023, 3, 1)),    # unseen key: inserted
    ])
    out, rejects = merge.scd2_apply(t, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK",
                                    return_rejects=True)
    c2 = sorted((r for r in out.collect() if r.CustomerID == "C002"), key=lambda r: r.StartDate)
    assert [(r.Region, r.EndDate, r.IsCurrent) for r in c2] == [
        ("East", date(2023, 2, 28), False), ("West", date(2023, 4, 30), False), ("North", date(9999, 12, 31), True)]
    assert out.where("CustomerID = 'C003'").count() == 1
    assert [r.CustomerID for r in rejects.collect()] == ["C004"]
    assert out.where("CustomerID = 'C011' AND IsCurrent").count() == 1
    sks = [r.SK for r in out.collect()]
    assert len(set(sks)) == len(sks) == 13 and max(sks) == 13


def test_scd3(spark, src):
    t = merge.scd_init(src, 3, KEYS, "Region", "EffectiveDate", current_col="CurrentRegion",
                       previous_col="PreviousRegion")
    out = merge.scd3_apply(t, change(spark, [("C001", "Alice Smith", "South", date(2023, 6, 15))]),
                           KEYS, "Region", "EffectiveDate", current_col="CurrentRegion",
                           previous_col="PreviousRegion")
    r = out.where("CustomerID = 'C001'").first()
    assert (r.Name, r.CurrentRegion, r.PreviousRegion, r.LastUpdatedDate) == \
        ("Alice Smith", "South", "North", date(2023, 6, 15))


def test_insert_if_absent(spark, src):
    t = merge.scd_init(src, 1, KEYS, "Region", "EffectiveDate")
    rows = change(spark, [("C001", "X", "Y", date(2024, 1, 1)), ("C011", "N", "E", date(2024, 1, 1)),
                          ("C011", "N", "E", date(2024, 1, 1))]).withColumnRenamed("EffectiveDate", "LastUpdatedDate")
    out = merge.insert_if_absent(t, rows, KEYS)
    assert out.count() == 11 and out.where("CustomerID = 'C001'").first().Name == "Alice Smith"


# The raw sales rows of the reference star schema.
RAW = [("1001", "2023-01-05", "C001", "Alice Smith", "USA", "P001", "Laptop", "Electronics", "1200.00", 1),
       ("1002", "2023-01-05", "C002", "Bob Johnson", "UK", "P003", "Mouse", "Electronics", "25.00", 2),
       ("1003", "2023-01-06", "C001", "Alice Smith", "USA", "P002", "Keyboard", "Electronics", "75.00", 1),
       ("1004", "2023-01-07", "C003", "Charlie Brown", "France", "P004", "Desk Chair", "Furniture", "150.00", 1),
       ("1005", "2023-01-07", "C002", "Bob Johnson", "UK", "P001", "Laptop", "Electronics", "1200.00", 1),
       ("1006", "2023-01-08", "C004", "Diana Prince", "Germany", "P005", "Coffee Maker", "Home Goods", "80.00", 1),
       ("1007", "2023-01-08", "C001", "Alice Smith", "USA", "P003", "Mouse", "Electronics", "25.00", 3),
       ("1008", "2023-01-09", "C005", "Eve Adams", "Japan", "P006", "Monitor", "Electronics", "300.00", 1),
       ("1009", "2023-01-09", "C003", "Charlie Brown", "France", "P002", "Keyboard", "Electronics", "75.00", 2),
       ("1010", "2023-01-10", "C004", "Diana Prince", "Germany", "P001", "Laptop", "Electronics", "1200.00", 1),
       ("1011", "2023-01-10", "C002", "Bob Johnson", "UK", "P005", "Coffee Maker", "Home Goods", "80.00", 1),
       ("1012", "2023-01-11", "C001", "Alice Smith", "USA", "P004", "Desk Chair", "Furniture", "150.00", 1),
       ("1013", "2023-01-11", "C005", "Eve Adams", "Japan", "P003", "Mouse", "Electronics", "25.00", 1),
       ("1014", "2023-01-12", "C006", "Frank White", "Australia", "P007", "Headphones", "Electronics", "100.00", 1),
       ("1015", "2023-01-12", "C003", "Charlie Brown", "France", "P006", "Monitor", "Electronics", "300.00", 1),
       ("1016", "2023-01-13", "C004", "Diana Prince", "Germany", "P002", "Keyboard", "Electronics", "75.00", 1),
       ("1017", "2023-01-13", "C001", "Alice Smith", "USA", "P007", "Headphones", "Electronics", "100.00", 2),
       ("1018", "2023-01-14", "C002", "Bob Johnson", "UK", "P004", "Desk Chair", "Furniture", "150.00", 1),
       ("1019", "2023-01-14", "C005", "Eve Adams", "Japan", "P001", "Laptop", "Electronics", "1200.00", 1),
       ("1020", "2023-01-15", "C006", "Frank White", "Australia", "P005", "Coffee Maker", "Home Goods", "80.00", 1)]


def test_star(spark):
    raw = spark.createDataFrame(RAW, "order_id string, order_date string, customer_id string, customer_name string, "
                                     "country string, product_id string, product_name string, category string, "
                                     "unit_price string, quantity int") \
        .withColumn("order_date", F.to_date("order_date")).withColumn("unit_price", F.col("unit_price").cast("decimal(18,2)"))
    dc = star.load_dim(raw, "customer_id", ["customer_name", "country"], "customer_key")
    dp = star.load_dim(raw, "product_id", ["product_name", "category"], "product_key")
    assert dc.count() == 6 and dp.count() == 7
    assert sorted(r.customer_key for r in dc.collect()) == list(range(1, 7))
    fact = star.load_fact(raw, dc, dp, date_col="order_date", customer_id="customer_id", product_id="product_id",
                          price="unit_price", quantity="quantity", keep=["order_id"])
    assert fact.count() == 20 and fact.where(~F.col("matched")).count() == 0
    cats = {r.category: (r.total_sales, r.units) for r in star.sales_by_category(fact, dp).collect()}
    assert cats == {"Electronics": (Decimal("6150.00"), 19), "Furniture": (Decimal("450.00"), 3),
                    "Home Goods": (Decimal("240.00"), 3)}
    top = (fact.join(dc, "customer_key").groupBy("customer_id").agg(F.sum("total_amount").alias("t"))
           .orderBy(F.desc("t")).limit(5).collect())
    assert [(r.customer_id, r.t) for r in top] == [
        ("C001", Decimal("1700.00")), ("C005", Decimal("1525.00")), ("C002", Decimal("1480.00")),
        ("C004", Decimal("1355.00")), ("C003", Decimal("600.00"))]
    dd = star.dim_date_for(raw, "order_date")
    assert dd.count() == 11
    d1 = dd.where("full_date = DATE'2023-01-08'").first()
    assert (d1.date_key, d1.day_of_week, d1.day_name, d1.month_name, d1.quarter) == (20230108, 0, "Sunday", "January", 1)


def test_assign_keys_continue(spark):
    df = spark.range(0, 50).select(F.col("id").alias("x"))
    out = assign_keys(df, "k", [("x", "desc")], start=100).collect()
    assert {(r.x, r.k) for r in out} == {(x, 100 + 50 - x) for x in range(50)}


def test_fact_keeps_unmatched_rows(spark):
    raw = spark.createDataFrame([("1", "2023-01-05", "C001", "P001", "10.00", 2),
                                 ("2", "2023-01-06", "C999", "P001", "10.00", 1)],
                                "order_id string, order_date string, customer_id string, product_id string, "
                                "unit_price string, quantity int").withColumn("order_date", F.to_date("order_date"))
    dc = spark.createDataFrame([(1, "C001")], "customer_key long, customer_id string")
    dp = spark.createDataFrame([(7, "P001")], "product_key long, product_id string")
    fact = star.load_fact(raw, dc, dp, date_col="order_date", customer_id="customer_id", product_id="product_id",
                          price="unit_price", quantity="quantity", keep=["order_id"])
    rows = {r.order_id: r for r in fact.collect()}
    assert rows["1"].matched and rows["1"].total_amount == Decimal("20.00") and rows["1"].date_key == 20230105
    assert not rows["2"].matched and rows["2"].customer_key is None and rows["2"].product_key == 7
    assert sorted(r.sale_key for r in rows.values()) == [1, 2]


@pytest.mark.parametrize("kind", [1, 3])
def test_duplicate_source_keys_fail(spark, src, kind):
    t = merge.scd_init(src, kind, KEYS, "Region", "EffectiveDate")
    batch = change(spark, [("C002", "Bob Johnson", "West", date(2023, 3, 1)),
                           ("C002", "Bob Johnson", "North", date(2023, 3, 1))])
    with pytest.raises(Exception, match="several rows for one key"):
        (merge.scd1_merge(t, batch, KEYS, ["Region"], "EffectiveDate") if kind == 1
         else merge.scd3_apply(t, batch, KEYS, "Region", "EffectiveDate")).collect()


def test_scd2_null_flag_rows_and_rejects(spark, src, monkeypatch):
    t = _scd2(spark, src).withColumn("IsCurrent", F.when(F.col("CustomerID") != "C003", F.col("IsCurrent")))
    batch = change(spark, [("C001", "A", "West", date(2023, 4, 1)), ("C001", "A", "North", date(2023, 4, 1)),
                           ("C001", "A", "North", date(2023, 4, 1)), ("C001", "A", "East", date(2023, 5, 1)),
                           ("C002", "B", "West", date(2020, 1, 1)), ("C004", "D", "West", None)])
    results = []
    for most in (10_000, 0):  # windows per key, and the spread numbering
        monkeypatch.setattr(merge, "MAX_VERSIONS_PER_TASK", most)
        out, rejects = merge.scd2_apply(t, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK", return_rejects=True)
        rows = out.collect()
        assert len(rows) == 12 and [r.IsCurrent for r in rows if r.CustomerID == "C003"] == [None]
        results.append(sorted(map(str, rows)))
        assert sorted((r.CustomerID, r.Region, r.reason) for r in rejects.collect()) == [
            ("C001", "North", "same day"), ("C001", "North", "same day"), ("C002", "West", "out of order"),
            ("C004", "West", "no date")]
    assert results[0] == results[1]


def test_scd3_overwrites_nothing_that_is_stored_as_null(spark, src):
    t = merge.scd_init(src, 3, KEYS, "Region", "EffectiveDate").withColumn("Current", F.lit(None).cast("string")) \
        .withColumn("LastUpdatedDate", F.lit(None).cast("date")).withColumn("Previous", F.lit("kept"))
    out = merge.scd3_apply(t, change(spark, [("C001", "A", None, date(2023, 4, 1))]), KEYS, "Region", "EffectiveDate")
    r = out.where("CustomerID = 'C001'").first()
    assert (r.Name, r.Previous) == (t.where("CustomerID = 'C001'").first().Name, "kept")


def test_affected_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (4, "d")], "k int, v string")
    assert tuple(merge.affected_rows(old, new, ["k"]).first()) == (1, 1, 1, 1)


def test_scd2_same_day_changes_keep_one(spark, src):
    t = _scd2(spark, src)
    batch = change(spark, [("C005", "Eve Black", "West", date(2023, 4, 1)),
                           ("C005", "Eve Black", "North", date(2023, 4, 1))])
    out = merge.scd2_apply(t, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK")
    c5 = sorted((r for r in out.collect() if r.CustomerID == "C005"), key=lambda r: r.StartDate)
    assert len(c5) == 2 and all(r.EndDate >= r.StartDate for r in c5)
    assert (c5[1].Region, c5[1].IsCurrent) == ("West", True)


def test_scd2_ranges_are_contiguous(spark, src):
    from datetime import timedelta
    t = _scd2(spark, src)
    batch = change(spark, [(f"C00{i}", "X", r, date(2023, m, 1)) for i in range(1, 6)
                           for m, r in ((3, "West"), (5, "North"), (7, "East"))])
    out = merge.scd2_apply(t, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK").collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r.CustomerID, []).append(r)
    for rows in by_key.values():
        rows.sort(key=lambda r: r.StartDate)
        assert [r.IsCurrent for r in rows] == [False] * (len(rows) - 1) + [True]
        for a, b in zip(rows, rows[1:]):
            assert a.EndDate + timedelta(days=1) == b.StartDate
        assert rows[-1].EndDate == date(9999, 12, 31)
    assert len({r.SK for r in out}) == len(out)


def _rows(df, drop=()):
    return sorted((tuple(r[c] for c in df.columns if c not in drop) for r in df.collect()), key=str)


def test_a_batch_with_a_null_key_is_idempotent(spark):
    """A NULL key is matched like any other: applied twice, all three types give the same table."""
    src = spark.createDataFrame([("C1", "A", "North", date(2023, 1, 1)), (None, "B", "West", date(2023, 1, 1))],
                                "CustomerID string, Name string, Region string, EffectiveDate date")
    batch = change(spark, [(None, "B", "East", date(2023, 6, 15)), ("C9", "Z", "South", date(2023, 6, 15))])
    t1 = merge.scd_init(src, 1, KEYS, "Region", "EffectiveDate")
    once = merge.scd1_merge(t1, batch, KEYS, ["Region"], "EffectiveDate")
    assert _rows(once) == _rows(merge.scd1_merge(once, batch, KEYS, ["Region"], "EffectiveDate")) and once.count() == 3
    t3 = merge.scd_init(src, 3, KEYS, "Region", "EffectiveDate")
    once = merge.scd3_apply(t3, batch, KEYS, "Region", "EffectiveDate")
    assert _rows(once) == _rows(merge.scd3_apply(once, batch, KEYS, "Region", "EffectiveDate")) and once.count() == 3
    t2 = merge.scd_init(src, 2, KEYS, "Region", "EffectiveDate", sk_col="SK")
    once = merge.scd2_apply(t2, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK")
    assert _rows(once) == _rows(merge.scd2_apply(once, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK"))
    current = [r for r in once.collect() if r["IsCurrent"] and r["CustomerID"] is None]
    assert [(r["Region"], r["StartDate"]) for r in current] == [("East", date(2023, 6, 15))]
    again, rejects = merge.scd2_apply(once, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK", return_rejects=True)
    assert {r["reason"] for r in rejects.collect()} == {"out of order"} and rejects.count() == 2


def test_snapshots_are_compared_by_buckets(spark):
    """Only rows of buckets whose digests differ are joined; null keys and null values are compared too."""
    old = spark.range(5000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("w"))
    new = old.where("k is null or k <> 17").withColumn("v", F.when(F.col("k") == 40, 99).when(F.col("k").isNull(), 5).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(9001, 1, "x")], "k long, v long, w string"))
    pairs, counts = merge.snapshot_pairs(old, new, ["k"], buckets=512)
    assert pairs.count() < 100
    n = counts.first()
    assert (n["n_old"], n["n_new"]) == (5000, 5000) and n["n_equal"] > 4800
    assert tuple(merge.affected_rows(old, new, ["k"]).first()) == (1, 2, 1, 4997)
    assert tuple(merge.affected_rows(old, old, ["k"]).first()) == (0, 0, 0, 5000)
    assert tuple(merge.affected_rows(old.limit(0), new, ["k"]).first()) == (5000, 0, 0, 0)


def test_a_change_batch_is_planned_once(spark):
    """The new snapshot reads the batch from its written table: few exchanges, and no numbering over the target."""
    t = merge.scd_init(change(spark, [("C1", "A", "North", date(2023, 1, 1)), ("C2", "B", "West", date(2023, 1, 1))]),
                       2, KEYS, "Region", "EffectiveDate", sk_col="SK")
    batch = change(spark, [("C1", "A", "South", date(2023, 6, 15)), ("C3", "C", "West", date(2023, 6, 15))])
    out, rejects = merge.scd2_apply(t, batch, KEYS, ["Name", "Region"], "EffectiveDate", sk_col="SK", return_rejects=True)
    for df in (out, rejects):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 11
