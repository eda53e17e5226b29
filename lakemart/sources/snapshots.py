"""Partitioned layers whose partitions are replaced one load at a time, and writes that audit themselves."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

_VERSIONS = "version bigint, part string, folder string"


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    """All published versions of the layer: one row per version and partition."""
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{path}/versions")
    except AnalysisException as e:  # nothing published yet
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace the partitions that occur in ``df``; others stay. Returns the version published.

    Rows are staged in a folder of their own load, one folder a partition. A
    version is a small table that names the folder of every partition; it is
    published by one file commit after the data are complete, so a write that
    fails is never seen and readers of the version before keep theirs. An
    empty ``df`` publishes a version that replaces nothing. A null partition
    value is a partition of its own. One writer at a time.
    """
    spark = df.sparkSession
    load = uuid.uuid4().hex[:12]
    staged = f"{path}/data/load={load}"
    df.write.partitionBy(*partition_by).parquet(staged)
    old = _versions(spark, path)
    last = old.agg(F.max("version")).first()[0] if old is not None else None
    # folders as they were written; read from the files' names and partition values, not from their rows
    rows = spark.read.schema(df.schema).parquet(staged)
    part = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in partition_by]), {"ignoreNullFields": "false"})
    # the hidden column holds a URI; readers take the plain path
    folder = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""), F.lit("+"), F.lit("%2B")))
    new = rows.select(part.alias("part"), folder.alias("folder")).distinct()
    version = (last or 0) + 1
    if last is not None:
        kept = old.where(F.col("version") == last).select("part", "folder").join(new.select("part"), "part", "left_anti")
        new = new.unionByName(kept)
    new.select(F.lit(version).cast("bigint").alias("version"), "part", "folder").coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def read_partitions(spark: SparkSession, path: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The layer as of ``version`` (the last one published by default); no rows before the first."""
    published = _versions(spark, path)
    rows = []
    if published is not None:
        if version is None:
            version = published.agg(F.max("version")).first()[0]
        rows = published.where(F.col("version") == version).select("folder").distinct().collect()  # one row a partition
    if not rows:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(StructType([*schema.fields, StructField("load", StringType())])).option(
        "basePath", f"{path}/data").parquet(*[r["folder"] for r in rows])
    return found.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def write_audited(df: DataFrame, path: str, load_id: str, ts_col: str, required: Sequence[str],
                  checks: Mapping[str, Column] | None = None, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Write a layer and return its audit, both from one pass over ``df``.

    One row: load id, record count, first and last event time, rows that lack
    a required field, one failure count for each of ``checks`` (a null result
    fails), and the status (SUCCESS clean, PARTIAL some bad rows, FAILED no
    good row or no row). The counts are observed by the writing tasks, so what
    is audited is what was written; the row is known when the write is over.
    """
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    checks = dict(checks or {})
    seen = Observation(f"audit-{uuid.uuid4().hex[:8]}")
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("record_count"), F.min(ts_col).cast("string").alias("lo"), F.max(ts_col).cast("string").alias("hi"),
        F.count_if(missing).alias("null_count"),
        *[F.count_if(~F.coalesce(e, F.lit(False))).alias(f"check{i}") for i, e in enumerate(checks.values())])
    out = watched.write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
    got = seen.get
    failed = [int(got[f"check{i}"] or 0) for i in range(len(checks))]
    n, nulls = int(got["record_count"] or 0), int(got["null_count"] or 0)
    status = "FAILED" if nulls == n else "PARTIAL" if nulls or any(failed) else "SUCCESS"
    kind = df.schema[ts_col].dataType.simpleString()
    names = "".join(f", `{name}` bigint" for name in checks)
    row = df.sparkSession.createDataFrame([(load_id, n, got["lo"], got["hi"], nulls, *failed, status)],
                                          f"load_id string, record_count bigint, lo string, hi string, null_count bigint{names}, load_status string")
    return row.select("load_id", "record_count", F.col("lo").cast(kind).alias("min_timestamp"), F.col("hi").cast(kind).alias("max_timestamp"),
                      "null_count", *[F.col(f"`{name}`") for name in checks], "load_status")
