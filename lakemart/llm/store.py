"""Tables written to the shared folder, to cut lineage between passes.

A written table survives lost executors; nothing is kept on an executor's own
disk or in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table beneath ``spark.checkpoint.dir``."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the folders of tables that ``written`` made. Only for tables that no later job reads, recomputed tasks included."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it that no column of ``df`` uses."""
    taken = {c.lower() for c in df.columns}
    name, k = wanted, 0
    while name.lower() in taken:
        k += 1
        name = f"{wanted}_{k}"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names have."""
    return [F.col(f"`{c}`") for c in df.columns]


# ids that may be broadcast: 8 bytes each, about 32 MB as a hash table
FEW_IDS = 1_000_000


def keep_ids(df: DataFrame, key: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """``df`` semi- or anti-joined on ``key`` with the one column of ``ids`` (without repeats, all or none of 8 bytes).

    Few ids, by their measured count, are broadcast, so that ``df`` is not
    shuffled; more are joined by a shuffle.
    """
    name = free_name(df, "kept_id")
    ids = ids.toDF(name)
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, df[f"`{key}`"] == F.col(name), how)
