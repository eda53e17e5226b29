"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from lakemart.plans.registry import load_all  # noqa: E402
from lakemart.plans.tables import TABLES  # noqa: E402
from lakemart.session import get_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return ("D", str(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


_SPARK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
          "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
          "BooleanType": "BOOLEAN", "FloatType": "FLOAT", "ShortType": "SMALLINT", "ByteType": "TINYINT"}


def type_diffs(df, res):
    spark_t = {f.name: _SPARK.get(type(f.dataType).__name__, f.dataType.simpleString()) for f in df.schema.fields}
    duck_t = {c[0]: str(c[1]).upper() for c in res.description}
    return {c: (spark_t[c], duck_t.get(c)) for c in spark_t if duck_t.get(c) != spark_t[c]}


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and os.path.isdir(sys.argv[1]) else "/root/testdata/sf0.01"
    names = [a for a in sys.argv[1:] if not os.path.isdir(a)]
    reg = load_all()
    if os.environ.get("LAKEMART_VANILLA"):
        # a plain session as an outside caller may build it: defaults, optional foreign time zone
        from pyspark.sql import SparkSession
        b = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        if os.environ.get("LAKEMART_TZ"):
            b = b.config("spark.sql.session.timeZone", os.environ["LAKEMART_TZ"])
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name, e in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = e.fn(spark, sf)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
            st = time.time() - t0
        except Exception:
            print(f"FAIL-SPARK {name}\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        if e.sql is None:
            print(f"rows-only {name}: {len(srows)} rows {st:.1f}s")
            ok += 1
            continue
        try:
            res = con.execute(e.sql)
            dcols = [c[0] for c in res.description]
            drows = res.fetchall()
        except Exception as ex:
            print(f"FAIL-SQL {name}: {ex}")
            bad += 1
            continue
        if sorted(cols) != sorted(dcols):
            print(f"COLS {name}: spark={cols} sql={dcols}")
            bad += 1
            continue
        td = type_diffs(df, res)
        if td:
            print(f"TYPES {name}: {td}")
        a, b = rows_of(cols, srows), rows_of(dcols, drows)
        if a == b:
            print(f"ok {name}: {len(a)} rows {st:.1f}s")
            ok += 1
        else:
            print(f"DIFF {name}: spark {len(a)} rows, sql {len(b)} rows")
            sa, sb = set(a), set(b)
            print("  spark-only:", list(sa - sb)[:3])
            print("  sql-only:  ", list(sb - sa)[:3])
            bad += 1
    print(f"summary ok={ok} bad={bad}")


if __name__ == "__main__":
    main()
