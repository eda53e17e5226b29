"""CSV bronze ingestion, layer sinks and load metadata (files in a fresh temp folder)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StringType, StructField, StructType

from lakemart.sources import files, metadata


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="lakemart-src-")


def _csv(folder, text):
    p = os.path.join(folder, "in.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_all_strings_and_inferred(spark, folder):
    p = _csv(folder, "id,amount,day\n1,10.50,2023-01-10\n2,7.25,2023-01-11\n")
    raw = files.read_bronze_csv(spark, p, infer=False, rescued=None)
    assert all(t == "string" for _, t in raw.dtypes)
    typed = files.read_bronze_csv(spark, p, infer=True, rescued=None)
    assert dict(typed.dtypes)["id"] == "int" and dict(typed.dtypes)["amount"] == "double"


def test_rescued_rows(spark, folder):
    p = _csv(folder, "id,amount\n1,10.50\n2,not-a-number\n3,4.00\n")
    schema = StructType([StructField("id", StringType()), StructField("amount", DecimalType(10, 2))])
    df = files.read_bronze_csv(spark, p, schema=schema).cache()
    bad = df.where(F.col("_rescued_data").isNotNull()).collect()
    assert [r.id for r in bad] == ["2"] and bad[0].amount is None
    assert df.count() == 3


def test_write_partitioned_and_append(spark, folder):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 11:00:00")], "id int, ts string") \
        .withColumn("load_day", F.to_date("ts"))
    out = files.write_layer(df, os.path.join(folder, "layer"), partition_by=["load_day"])
    assert sorted(x for x in os.listdir(out) if x.startswith("load_day=")) == ["load_day=2024-01-01",
                                                                                "load_day=2024-01-02"]
    back = spark.read.parquet(out)
    assert back.where("load_day = DATE'2024-01-02'").count() == 1
    target = StructType([StructField("id", StringType()), StructField("day", DateType())])
    path = os.path.join(folder, "silver")
    files.append_layer(spark.createDataFrame([("7", "2024-02-01")], "id string, day string"), path, target)
    files.append_layer(spark.createDataFrame([("8", "2024-02-02")], "id string, day string"), path, target)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception):  # ANSI: a value that does not fit the target type fails the job
        files.append_layer(spark.createDataFrame([("9", "not a date")], "id string, day string"), path, target)


def test_load_metadata_and_audit(spark, folder):
    p = _csv(folder, "event_id,ts,station\n1,2024-01-01 08:00:00,A\n1,2024-01-01 08:00:00,A\n2,2024-01-02 09:00:00,\n")
    scan = spark.read.option("header", True).csv(p)
    df = metadata.with_load_metadata(scan, "L1", "2024-01-03 00:00:00")
    audit = metadata.load_audit(df, "ts", "event_id", ["station"]).first()
    assert (audit.load_id, audit.file_name, audit.record_count) == ("L1", "in.csv", 3)
    assert (audit.null_count, audit.duplicate_count, audit.load_status) == (1, 1, "PARTIAL")


def test_views_and_preview(spark):
    files.register_views({"lm_v": spark.range(5)})
    assert spark.sql("SELECT COUNT(*) FROM lm_v").first()[0] == 5
    assert files.preview(spark.range(100), 7).count() == 7
