"""Relational building blocks: semi/anti joins, group pair counts, shifted
self-joins, conditional counts, shares of a total, top-k groups, defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import as_col, count_when, ratio


# a task's share where joins and groupings hold every row: about 360 bytes a row in sorts and hash maps
ROWS_PER_TASK, LEAST_TASKS = 250_000, 16


def task_count(rows: int) -> int | None:
    """Number of tasks that holds each to ``ROWS_PER_TASK`` of ``rows``; None if few rows leave it to Spark.

    Spark's own number of partitions is fixed, and merging them goes by their
    compressed bytes, so that a task's memory grows with the table.
    """
    n = -(-rows // ROWS_PER_TASK)
    return n if n >= LEAST_TASKS else None


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _join_cond(left: DataFrame, right: DataFrame, key, other_key) -> Column:
    lk, rk = _keys(key), _keys(other_key or key)
    cond = None
    for a, b in zip(lk, rk):
        c = left[a] == right[b]
        cond = c if cond is None else cond & c
    return cond


def orders_without(df: DataFrame, other: DataFrame, key, other_key=None) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (``LEFT JOIN .. IS NULL``).

    Emitted as a ``left_anti`` join: Catalyst keeps the written LEFT JOIN +
    filter form as an outer join, which carries every matched row through
    the join only to drop it.
    """
    other = other.select(*_keys(other_key or key)).distinct().alias("_r")
    return df.join(other, _join_cond(df, other, key, other_key), "left_anti")


def orders_with(df: DataFrame, other: DataFrame, key, other_key=None) -> DataFrame:
    """Rows of ``df`` with at least one match in ``other`` (``EXISTS``)."""
    other = other.select(*_keys(other_key or key)).distinct().alias("_r")
    return df.join(other, _join_cond(df, other, key, other_key), "left_semi")


def pair_counts_within(df: DataFrame, group: str | Sequence[str], id_col: str,
                       members: str = "members", pairs: str = "pairs") -> DataFrame:
    """Unordered same-group pairs (``a.id < b.id``), counted per group.

    The written self-join emits n·(n-1)/2 rows per group, quadratic in the
    largest group. The count is exact from one partial aggregate, so a hot
    group costs no more than any other; pairs are not materialised.
    """
    g = _keys(group)
    n = F.count_distinct(F.col(id_col))
    return (df.where(F.col(id_col).isNotNull()).groupBy(*g)
            .agg(n.alias(members))
            .withColumn(pairs, F.expr(f"`{members}` * (`{members}` - 1) div 2")))


def next_period_keys(df: DataFrame, key: str, period: str, months: int = 1) -> DataFrame:
    """(key, period) with activity in ``period`` and in ``period + months``.

    The shifted self-join as one aggregate: a key's distinct months (bounded
    by the calendar) are combined map-side and looked up in their own set.
    A null key takes no part, as in the join.
    """
    own = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_set(period).alias("_p"))
    both = F.array_intersect("_p", F.transform("_p", lambda m: F.add_months(m, -months)))
    return own.select(key, F.explode(both).alias(period))


def with_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """``col LIKE 'prefix%'`` (case-sensitive); pushed to the scan as StringStartsWith."""
    return df.where(F.col(col).startswith(prefix))


def count_if_report(df: DataFrame, predicates: Mapping[str, Column], total: str | None = "total_rows") -> DataFrame:
    """One row: ``SUM(CASE WHEN p THEN 1 ELSE 0 END)`` per named predicate, one scan."""
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [count_when(p).alias(name) for name, p in predicates.items()]
    return df.agg(*aggs)


def share_of_total(df: DataFrame, key: str | Sequence[str], count_col: str = "n",
                   pct_col: str = "pct", scale: int = 4) -> DataFrame:
    """Count per key and its percentage of all rows.

    The denominator is a scalar subquery over the aggregated rows (one value),
    not a window over them, so no single-partition exchange appears.
    """
    agg = df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias(count_col))
    # bind the scalar once: each textual use of a subquery column is its own execution
    return (agg.withColumn("_lm_total", agg.select(F.sum(count_col)).scalar())
            .withColumn(pct_col, ratio(F.col(count_col), F.col("_lm_total"), scale, pct=True))
            .drop("_lm_total"))


def top_groups(df: DataFrame, by: str | Sequence[str], aggs: Sequence[Column],
               order: Sequence[Column], k: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """Top ``k`` groups by an aggregate: groupBy + ORDER BY .. LIMIT k.

    Spark plans this as ``TakeOrderedAndProject``: each task keeps its own
    top k and only those reach the final merge.
    """
    keys = _keys(by)
    tb = list(tie_break) or keys
    return df.groupBy(*keys).agg(*aggs).orderBy(*order, *[F.asc(c) for c in tb]).limit(k)


def top_rows(df: DataFrame, order: Sequence[Column], k: int, tie_break: Sequence[str]) -> DataFrame:
    """Top ``k`` rows by a column (``ORDER BY .. LIMIT k``): each task keeps its
    own best ``k`` (``TakeOrderedAndProject``), only those are merged."""
    return df.orderBy(*order, *[F.asc(c) for c in tie_break]).limit(k)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``COALESCE(col, default)`` for the listed columns, types kept."""
    out = df
    for c, v in defaults.items():
        dtype = df.schema[c].dataType
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(dtype)))
    return out


__all__ = [
    "orders_without", "orders_with", "with_prefix", "top_rows", "pair_counts_within", "next_period_keys",
    "count_if_report", "share_of_total", "top_groups", "fill_defaults", "as_col",
]
