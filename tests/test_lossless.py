"""Rows and values that must not get lost."""

import pytest
from pyspark.sql import functions as F

from lakemart import session
from lakemart.functions.columns import money_sum
from lakemart.operators import quality, relational, sales
from lakemart.plans import registry
from lakemart.sources import files, metadata


def test_totals_count_keys_of_either_side(spark):
    parents = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 1.0)], "k int, total double")
    parts = spark.createDataFrame([(1, 4.0), (1, 6.0), (2, 9.0), (9, 1.0)], "k int, part double")
    r = quality.total_consistency(parents, parts, "k", "total", "part").first()
    assert (r.n_keys, r.n_consistent, r.n_inconsistent, r.n_without_parts, r.n_without_parent) == (4, 1, 1, 1, 1)


def test_wide_sums(spark):
    df = spark.range(3).select(F.lit("5000000000000000.00").cast("decimal(18,2)").alias("x"))
    assert str(df.agg(money_sum("x")).first()[0]) == "15000000000000000.00"


def test_pair_counts_are_exact(spark):
    df = spark.createDataFrame([("a", 1)], "g string, id int")
    out = relational.pair_counts_within(df, "g", "id")
    exact = out.select("members", "pairs").limit(0).unionByName(
        spark.createDataFrame([(600_000_003, 0)], "members long, pairs long"))
    assert exact.select(F.expr("members * (members - 1) div 2")).first()[0] == 180000001500000003
    assert out.first().pairs == 0


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_bronze_csv(spark, str(tmp_path)).collect()


def test_csv_quotes_and_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;note\n1;|two\nlines; one|\n')
    rows = files.read_bronze_csv(spark, str(tmp_path), sep=";", quote="|", multi_line=True).collect()
    assert [(r.id, r.note) for r in rows] == [("1", "two\nlines; one")]


def test_audit_does_not_count_null_keys_as_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (2, "a")], "k int, f string").select(
        "k", F.lit("l").alias("_load_id"), F.col("f").alias("_file_name"), F.lit(1).alias("_load_date"), F.lit(1).alias("ts"))
    r = metadata.load_audit(df, "ts", "k", ["ts"]).first()
    assert (r.duplicate_count, r.load_status) == (0, "SUCCESS")


def test_suite_passes_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, v int")
    rows = quality.run_suite(df, ["k"], [["k"]], {"positive": F.col("v") > 0}).collect()
    assert {(r.failures, r.status) for r in rows} == {(0, "pass")}


def test_checkpoint_folder_must_be_shared(monkeypatch):
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_duplicates_by_digest(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, "a"), ("", "a"), ("", "a"), ("b", "c")], "x string, y string")
    got = sorted((r.x or "-", r.y or "-", r.n_copies) for r in quality.duplicate_rows(df).collect())
    assert got == [("-", "a", 2), ("a", "-", 2)]  # ("", "a"): the empty text prints as "-" here
    r = quality.duplication_rate(df).first()
    assert (r.total_rows, r.distinct_rows) == (6, 4)
    per = {r.x: r.duplicate_rows for r in quality.duplication_rate(df, by=["x"]).collect()}
    assert per == {"a": 1, None: 0, "": 1, "b": 0}


def test_unexplained_revenue_counts_in_the_average(spark):
    orders = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "order_id int, customer_id int")
    revenue = spark.createDataFrame([(1, "10"), (2, "10"), (3, "30"), (4, "1000")], "order_id int, r string").select(
        "order_id", F.col("r").cast("decimal(18,2)").alias("revenue"))
    assert sales.big_spenders(orders, revenue).count() == 0
    assert [r.customer_id for r in sales.big_spenders(orders, revenue.where("order_id < 4")).orderBy("customer_id").collect()] == [7, 8]


def test_library_lists_its_queries_without_an_oracle_engine():
    assert registry.load_all() and "duckdb" not in registry.__dict__


def test_typed_columns_are_current():
    from lakemart.plans.double_columns import DOUBLE_COLUMNS
    from tools.double_columns import found
    assert found("/root/testdata/sf0.001") == DOUBLE_COLUMNS


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0, 2.0, 9.0], [5.0] * 7 + [1.0], [float(i * i % 17) for i in range(41)]])
def test_bracketed_quantiles_are_exact(spark, values):
    import numpy as np
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ps = (0.0, 0.25, 0.5, 0.95, 1.0)
    got = spark.range(1).select(quality.exact_quantiles(df, "v", ps).alias("q")).first().q
    assert np.allclose(list(got), np.quantile(values, ps))
