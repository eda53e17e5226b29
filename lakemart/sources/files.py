"""Bronze CSV ingestion and layer sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_bronze_csv(spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = False,
                    rescued: str | None = "_rescued_data", header: bool = True, sep: str = ",",
                    quote: str = '"', escape: str = "\\", multi_line: bool = False) -> DataFrame:
    """CSV → bronze DataFrame.

    * ``schema`` given: used as is (no inference pass);
    * ``infer=True``: types inferred from the data (one extra pass over the files);
    * otherwise every column is a string (the header names the columns).

    With ``rescued`` set, rows that do not fit the schema are kept
    (PERMISSIVE) and their raw text lands in that column; the other
    columns of such a row are NULL where they failed to parse.

    A file whose header names other columns, or the same ones in another
    order, fails the read instead of being bound by position.
    """
    reader = (spark.read.option("header", header).option("sep", sep).option("quote", quote).option("escape", escape)
              .option("multiLine", multi_line).option("enforceSchema", not header))
    if schema is None:
        probe = reader.option("inferSchema", infer).csv(path)
        schema = probe.schema if infer else StructType(
            [StructField(f.name, StringType(), True) for f in probe.schema.fields])
    if rescued:
        schema = StructType(list(schema.fields) + [StructField(rescued, StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescued)
    return reader.schema(schema).csv(path)


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None,
                fmt: str = "parquet") -> str:
    """Create-or-replace (CTAS) a layer table at ``path``; returns the path.

    Never point ``path`` at a table the plan reads: write a new snapshot.
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def append_layer(df: DataFrame, path: str, schema: StructType, fmt: str = "parquet") -> str:
    """``INSERT INTO t (cols) SELECT ..``: select the target columns in order,
    cast each to its target type (ANSI: a value that does not fit fails the
    job rather than being silently changed), append."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    df.select(*cols).write.mode("append").format(fmt).save(path)
    return path


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Replaceable named views (``CREATE OR REPLACE TEMP VIEW``)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """``SELECT * .. LIMIT n`` (no order: any n rows)."""
    return df.limit(n)
