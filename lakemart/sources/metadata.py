"""Ingestion metadata columns and the per-load audit record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import count_when


def with_load_metadata(scan: DataFrame, load_id: str, load_ts: str) -> DataFrame:
    """Add ``_file_name`` (from the file source's hidden ``_metadata``),
    ``_load_date`` and ``_load_id``. Call on a file scan, before other steps."""
    return scan.select("*", F.col("_metadata.file_name").alias("_file_name"),
                       F.lit(load_ts).cast("timestamp_ntz").alias("_load_date"),
                       F.lit(load_id).alias("_load_id"))


def load_audit(df: DataFrame, ts_col: str, key: str, required: Sequence[str],
               load_id: str = "_load_id", file_col: str = "_file_name", load_ts: str = "_load_date") -> DataFrame:
    """One audit row per (load, file): record count, event-time window,
    rows missing a required field, surplus copies of the key, and status
    (SUCCESS clean, PARTIAL some bad rows, FAILED no good row)."""
    missing = None
    for c in required:
        e = F.col(c).isNull()
        missing = e if missing is None else missing | e
    audit = df.groupBy(F.col(load_id).alias("load_id"), F.col(file_col).alias("file_name")).agg(
        F.max(load_ts).alias("load_date"), F.count(F.lit(1)).alias("record_count"),
        F.min(ts_col).alias("min_timestamp"), F.max(ts_col).alias("max_timestamp"),
        count_when(missing).alias("null_count"),
        (F.count(F.col(key)) - F.count_distinct(F.col(key))).alias("duplicate_count"))
    status = (F.when(F.col("null_count") == F.col("record_count"), "FAILED")
              .when((F.col("null_count") > 0) | (F.col("duplicate_count") > 0), "PARTIAL").otherwise("SUCCESS"))
    return audit.withColumn("load_status", status)
