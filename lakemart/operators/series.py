"""Running and rolling sums over series of any length.

A window ordered over a whole series holds it in one task. Here the rows are
dealt to buckets of consecutive (series, order) keys, as for the row numbers of
``ranking``: a narrow pass sums every bucket, the last pass sums within each
bucket and adds what the series had before it. A rolling sum is the difference
of two running sums ``n`` rows apart; the rows are cut into blocks by their
position, and every block also gets the last ``n`` positions of the one before.

Sums are exact, so values must be whole numbers or decimals.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from lakemart.operators.ranking import _BUCKET, _Buckets, _dealt, _keys, _literal

_BLOCK_ROWS = 50_000
_TOTALS = ("_lm_pos", "_lm_sum", "_lm_met")


def _sum_type(df: DataFrame, value: str) -> str:
    t = df.schema[value].dataType
    if isinstance(t, DecimalType):
        return f"decimal(38,{t.scale})"
    if isinstance(t, IntegralType):
        return "bigint"
    raise TypeError(f"{value}: sums of {t.simpleString()} depend on their order; cast to a decimal")


def _carried(rows: DataFrame, buckets: _Buckets, part: int, kind: str) -> Column:
    """Literal array, one entry a bucket: rows, sum and non-null values that the series which the bucket begins
    with has in earlier buckets. One row a bucket reaches the driver."""
    next_too = buckets.begins(F.col(_BUCKET) + 1, part)
    tails = rows.where(next_too).groupBy(_BUCKET).agg(
        F.count(F.lit(1)).alias("pos"), F.coalesce(F.sum("_lm_v"), F.lit(0)).cast(kind).alias("sum"), F.count("_lm_v").alias("met"))
    by_bucket = {r[_BUCKET]: r for r in tails.collect()}
    heads, out, carry = buckets.heads(part), [], (0, 0, 0)
    for i, head in enumerate(heads):
        tail = by_bucket.get(i - 1)
        tail = (tail["pos"], tail["sum"], tail["met"]) if tail else (0, 0, 0)
        on = carry if i and head == heads[i - 1] else (0, 0, 0)
        carry = tuple(x + y for x, y in zip(tail, on)) if i else (0, 0, 0)
        out.append(json.dumps({"pos": carry[0], "sum": str(carry[1]), "met": carry[2]}))
    return _literal(out, "struct<pos:bigint,sum:string,met:bigint>")


def _totals(df: DataFrame, value: str, by: Sequence[str], order: Sequence, num_partitions: int | None) -> DataFrame:
    """``df`` with position, running sum (nulls as 0) and running count of non-null values in each series."""
    kind = _sum_type(df, value)
    keys = _keys(by) + _keys(order)
    names = [k if isinstance(k, str) else k[0] for k in [*by, *order]]
    narrow = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(names)], F.col(f"`{value}`").alias("_lm_v"))
    buckets = _dealt(narrow.drop("_lm_v"), keys, num_partitions, None, spread=False)
    part = len(by) if len(buckets.keys) >= len(by) else 0
    rows = df.withColumn(_BUCKET, buckets.number())
    w = Window.partitionBy(_BUCKET, *[k.expr for k in keys[:len(by)]]).orderBy(*[k.sort() for k in keys[len(by):]]) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(f"`{value}`")
    here = (F.row_number().over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("bigint"),
            F.sum(F.coalesce(v, F.lit(0)).cast(kind)).over(w).cast(kind), F.count(v).over(w))
    if buckets.texts and (part or not by):
        at = F.get(_carried(narrow.withColumn(_BUCKET, buckets.number()), buckets, part, kind), F.col(_BUCKET))
        goes_on = (F.col(_BUCKET) > 0) & buckets.begins(F.col(_BUCKET), part)
        here = tuple((h + F.when(goes_on, at[f].cast(t)).otherwise(F.lit(0).cast(t))).cast(t)
                     for h, f, t in zip(here, ("pos", "sum", "met"), ("bigint", kind, "bigint")))
    return rows.select("*", *[h.alias(n) for h, n in zip(here, _TOTALS)]).drop(_BUCKET)


def running_sum(df: DataFrame, value: str, order: Sequence, by: Sequence[str] = (), out: str = "running_sum",
                num_partitions: int | None = None) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY by ORDER BY order ROWS UNBOUNDED PRECEDING)``, one series may be the whole table.

    ``order`` (names or ``(name, "desc")``) must end in a unique tie-break.
    Null until the series' first non-null value; a null series key is a
    series of its own. Series of up to 200,000 rows in all are summed in one
    window; ``num_partitions`` sets the number of buckets. Each row is
    shuffled once and nothing is checkpointed.
    """
    done = _totals(df, value, list(by), list(order), num_partitions)
    return done.withColumn(out, F.when(F.col("_lm_met") > 0, F.col("_lm_sum"))).drop(*_TOTALS)


def rolling_sum(df: DataFrame, value: str, order: Sequence, n: int, by: Sequence[str] = (), out: str = "rolling_sum",
                num_partitions: int | None = None, block_rows: int = _BLOCK_ROWS) -> DataFrame:
    """The sum over a row and the ``n - 1`` rows before it in its series (``ROWS n-1 PRECEDING``).

    Work a row does not grow with ``n``: two running sums are subtracted.
    Null where all ``n`` values are null. Blocks hold ``max(block_rows, n)``
    positions and as many as ``n`` borrowed ones.
    """
    if n < 1:
        raise ValueError(n)
    size = max(block_rows, n)
    at = F.col("_lm_pos") - 1
    own = F.floor(at / size).cast("bigint")
    done = _totals(df, value, list(by), list(order), num_partitions).withColumn("_lm_own", own)
    blocks = F.when(at % size >= size - n, F.array(F.col("_lm_own"), F.col("_lm_own") + 1)).otherwise(F.array("_lm_own"))
    w = Window.partitionBy(*[F.col(f"`{b}`") for b in by], "_lm_block").orderBy("_lm_pos")
    spread = done.withColumn("_lm_block", F.explode(blocks))

    def last(c: str) -> Column:
        return F.col(c) - F.coalesce(F.lag(c, n).over(w), F.lit(0))

    summed = spread.withColumn("_lm_n", last("_lm_met")).withColumn("_lm_r", last("_lm_sum").cast(_sum_type(df, value)))
    return summed.where(F.col("_lm_block") == F.col("_lm_own")).withColumn(out, F.when(F.col("_lm_n") > 0, F.col("_lm_r"))) \
        .drop(*_TOTALS, "_lm_own", "_lm_block", "_lm_n", "_lm_r")
