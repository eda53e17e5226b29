"""CSV files bound by the names in their headers, with malformed fields rescued one by one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# a header table of at most this many characters is broadcast
_SMALL = 8 << 20
# keys of the rescue map that are no columns
LINE, FILE = "_line", "_file_path"


def read_csv_by_name(spark: SparkSession, path: str, schema: StructType, rescued: str = "_rescued_data",
                     header: bool = True, sep: str = ",", quote: str = '"', escape: str = "\\",
                     formats: Mapping[str, str] | None = None) -> DataFrame:
    """CSV files whose headers may differ → the columns of ``schema`` and a map of what did not fit.

    * Fields are bound by the name in their own file's header (trimmed, case
      ignored), so reordered and widened files read right; a column that a
      file lacks is null. Without ``header`` fields are bound by position.
    * Every field is converted by itself: one that does not fit its type is
      null and lands in the map ``rescued`` under its column's name; the other
      fields of the row keep their values. ``formats`` gives date patterns.
    * Columns that ``schema`` lacks land in the map by their names (a name
      that repeats gets its position), a line with more fields than its header
      as a whole under ``_line``; ``_file_path`` is added to each map.

    Rows with nothing to rescue have a null map. Empty fields are null, blank
    lines and repeated header lines are left out. A quoted line break is not
    supported: a line is a row. The headers, one row a file, are joined to the
    lines; they are broadcast if their measured size is small.
    """
    options = {"sep": sep, "quote": quote, "escape": escape}
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("start"),
        F.monotonically_increasing_id().alias("no")).where(F.trim("value") != "")

    def fields(text: Column, width: int) -> Column:
        one = F.from_csv(text, ", ".join(f"c{i} string" for i in range(width)), options)
        return F.array(*[one[f"c{i}"] for i in range(width)])

    wanted = [f.name.lower() for f in schema.fields]
    if header:
        heads = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "no").alias("head"))
        size = heads.agg(F.coalesce(F.max(F.length("head") - F.length(F.replace("head", F.lit(sep)))), F.lit(0)).alias("n"),
                         F.coalesce(F.sum(F.length("head") + F.length("file")), F.lit(0)).alias("size")).first()
        width = size["n"] + 1
        text = F.regexp_replace("head", "^﻿", "")
        names = heads.select("file", "head", F.transform(fields(text, width), lambda x: F.trim(x)).alias("name"))
        # as many names as the header has fields
        names = names.withColumn("name", F.slice("name", F.lit(1), F.length("head") - F.length(F.replace("head", F.lit(sep))) + 1))
        low = F.transform("name", lambda x: F.lower(F.coalesce(x, F.lit(""))))
        names = names.withColumn("low", low)
        taken = [*wanted, LINE, FILE]
        keys = F.transform("name", lambda x, i: F.when(
            F.coalesce(x, F.lit("")).isin("", LINE, FILE) | (F.array_position("low", F.lower(x)) != i + 1),
            F.concat_ws("_", x, (i + 1).cast("string"))).otherwise(x))
        other = F.filter(F.transform("low", lambda x, i: F.when(~x.isin(taken) | (F.array_position("low", x) != i + 1), i + 1)),
                         lambda i: i.isNotNull())
        names = names.select("file", "head", keys.alias("key"), F.size("name").alias("width"), other.alias("other"),
                             F.array(*[F.array_position("low", F.lit(w)).cast("int") for w in wanted]).alias("at"))
        if size["size"] <= _SMALL:
            names = F.broadcast(names)
        rows = lines.join(names, "file").where(F.col("value") != F.col("head"))
    else:
        width = len(wanted)
        rows = lines.select("*", F.lit(width).alias("width"), F.array().cast("array<string>").alias("key"),
                            F.array().cast("array<int>").alias("other"), F.array(*[F.lit(i + 1) for i in range(width)]).alias("at"))
    rows = rows.withColumn("f", fields(F.col("value"), width + 1))

    def raw(i: int) -> Column:
        at = F.get("at", F.lit(i))
        return F.when(at > 0, F.get("f", at - 1))

    def converted(i: int) -> Column:
        field = schema.fields[i]
        if isinstance(field.dataType, StringType):
            return raw(i)
        pattern = (formats or {}).get(field.name)
        if pattern:
            return F.try_to_timestamp(raw(i), F.lit(pattern)).cast(field.dataType)
        return raw(i).try_cast(field.dataType)

    rows = rows.select("file", "value", "f", "width", "key", "other",
                       F.struct(*[raw(i).alias(f"r{i}") for i in range(len(wanted))]).alias("raw"),
                       F.struct(*[converted(i).alias(f"v{i}") for i in range(len(wanted))]).alias("v"))
    entry = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    bad = [F.when(F.col(f"raw.r{i}").isNotNull() & F.col(f"v.v{i}").isNull(), entry(F.lit(f.name), F.col(f"raw.r{i}")))
           for i, f in enumerate(schema.fields) if not isinstance(f.dataType, StringType)]
    extra = F.transform(F.filter("other", lambda i: F.get("f", i - 1).isNotNull()),
                        lambda i: entry(F.get("key", i - 1), F.get("f", i - 1)))
    surplus = F.exists(F.slice("f", F.col("width") + 1, F.lit(width + 1)), lambda x: x.isNotNull())
    found = F.concat(F.array_compact(F.array(*bad, F.when(surplus, entry(F.lit(LINE), F.col("value"))))), extra)
    rows = rows.select("v", "file", found.alias("found"))
    whole = F.concat("found", F.array(entry(F.lit(FILE), F.col("file"))))
    return rows.select(*[F.col(f"v.v{i}").alias(f.name) for i, f in enumerate(schema.fields)],
                       F.when(F.size("found") > 0, F.map_from_entries(whole)).alias(rescued))
