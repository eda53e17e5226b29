"""CSV by header names, partitions replaced by load, audits observed while writing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakemart.sources import by_name, metadata, snapshots

SCHEMA = "id bigint, name string, price double, day date"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def rescue(m):
    return None if m is None else {k: v for k, v in m.items() if k != by_name.FILE}


def test_fields_are_bound_by_name_and_rescued_one_by_one(spark, tmp_path):
    files = {"a.csv": "id,name,price,day\n1,x,1.5,2024-01-02\n2,\"y, z\",oops,2024-13-01\n\n",
             "b.csv": "Price , DAY,id,name\n2.5,2024-01-03,3,w\nid,bad,#4,v\n",
             "c.csv": "id,extra,name,id\n5,more,n,7\n6,,m,\n8,e,k,1,surplus\n",
             "d.csv": "name,price\nonly,9\nname,price\nshort\n", "e.csv": "id,name,price,day\n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = by_name.read_csv_by_name(spark, str(tmp_path), schema(spark)).collect()
    got = sorted(((r.id, r.name, r.price, r.day, rescue(r._rescued_data)) for r in rows), key=str)
    assert got == sorted([
        (1, "x", 1.5, dt.date(2024, 1, 2), None), (2, "y, z", None, None, {"price": "oops", "day": "2024-13-01"}),
        (3, "w", 2.5, dt.date(2024, 1, 3), None), (None, "v", None, None, {"price": "id", "day": "bad", "id": "#4"}),
        (5, "n", None, None, {"extra": "more", "id_4": "7"}), (6, "m", None, None, None),
        (8, "k", None, None, {"extra": "e", "id_4": "1", "_line": "8,e,k,1,surplus"}),
        (None, "only", 9.0, None, None), (None, "short", None, None, None)], key=str)
    assert all(r._rescued_data[by_name.FILE].endswith(".csv") for r in rows if r._rescued_data)


def test_without_header_and_with_patterns(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1;a;2,5;03/01/2024\n2;b;7;2024-01-03\n3;c\n4;d;1;04/01/2024;5\n")
    rows = by_name.read_csv_by_name(spark, str(tmp_path), schema(spark), header=False, sep=";", formats={"day": "dd/MM/yyyy"}).collect()
    assert sorted(((r.id, r.price, r.day, rescue(r._rescued_data)) for r in rows), key=str) == sorted([
        (1, None, dt.date(2024, 1, 3), {"price": "2,5"}), (2, 7.0, None, {"day": "2024-01-03"}), (3, None, None, None),
        (4, 1.0, dt.date(2024, 1, 4), {"_line": "4;d;1;04/01/2024;5"})], key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_only_the_partitions_loaded_are_replaced(spark, tmp_path):
    path, cols = str(tmp_path / "layer"), "k int, v string, day string"
    first = spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2"), (3, "c", None), (4, "d", "d/4 =")], cols)
    assert snapshots.read_partitions(spark, path, first.schema).count() == 0
    assert snapshots.replace_partitions(first, path, ["day"]) == 1
    again = spark.createDataFrame([(20, "B", "d2"), (21, "B", "d2"), (5, "e", "d5"), (30, "C", None)], cols)
    assert snapshots.replace_partitions(again, path, ["day"]) == 2
    want = [(1, "a", "d1"), (20, "B", "d2"), (21, "B", "d2"), (30, "C", None), (4, "d", "d/4 ="), (5, "e", "d5")]
    assert rows_of(snapshots.read_partitions(spark, path, first.schema)) == sorted(want, key=str)
    assert rows_of(snapshots.read_partitions(spark, path, first.schema, version=1)) == rows_of(first)
    assert snapshots.replace_partitions(again, path, ["day"]) == 3
    assert rows_of(snapshots.read_partitions(spark, path, first.schema)) == sorted(want, key=str)


def test_a_failed_load_is_never_seen(spark, tmp_path):
    path = str(tmp_path / "layer")
    good = spark.createDataFrame([(1, "d1"), (2, "d2")], "k int, day string")
    snapshots.replace_partitions(good, path, ["day"])
    bad = good.withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("broken"))).otherwise(9).cast("int"))
    with pytest.raises(Exception, match="broken"):
        snapshots.replace_partitions(bad, path, ["day"])
    assert rows_of(snapshots.read_partitions(spark, path, good.schema)) == [(1, "d1"), (2, "d2")]


def test_the_audit_is_observed_by_the_write(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = spark.createDataFrame([(1, None, dt.datetime(2024, 1, 1, 5)), (2, "x", dt.datetime(2024, 1, 3, 0, 0, 0, 7)), (3, "y", None)],
                                 "k int, v string, ts timestamp_ntz")
    got = snapshots.write_audited(rows, path, "L1", "ts", ["v"], checks={"small": F.col("k") < 3}).first()
    back = spark.read.parquet(path)
    audit = metadata.load_audit(back.withColumn("_load_id", F.lit("L1")).withColumn("_file_name", F.lit("f")).withColumn("_load_date", F.lit("d")),
                                "ts", "k", ["v"]).first()
    assert (got.record_count, got.min_timestamp, got.max_timestamp, got.null_count, got.load_status) == (
        audit.record_count, audit.min_timestamp, audit.max_timestamp, audit.null_count, "PARTIAL")
    assert got.small == 1 and back.count() == 3
    none = snapshots.write_audited(rows.where("k > 9"), str(tmp_path / "none"), "L2", "ts", ["v"]).first()
    assert (none.record_count, none.min_timestamp, none.load_status) == (0, None, "FAILED")
