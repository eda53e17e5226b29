"""Reusable column expressions.

Money is carried as ``DECIMAL(18,2)`` and summed as ``DECIMAL(38,2)``, so
that sums are exact and reproducible across engines (double sums depend on
the order rows are added in, which changes with partitioning) and cannot
overflow.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(38, 2)


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Exact two-decimal amount."""
    return as_col(c).cast(MONEY)


def money_sum(c: str | Column) -> Column:
    """Exact sum of amounts, returned as ``DECIMAL(38,2)``."""
    return F.sum(as_col(c).cast(MONEY_SUM)).cast(MONEY_SUM)


def count_when(pred: Column) -> Column:
    """``SUM(CASE WHEN pred THEN 1 ELSE 0 END)``: NULL on zero rows, like SQL."""
    return F.sum(F.when(pred, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def half_up_div(num: Column, den: Column, scale: int) -> Column:
    """Exact ``round(num / den, scale)`` (HALF_UP) for integer-valued num/den,
    as ``DECIMAL(18, scale)``; NULL when ``den`` is 0.

    Integer arithmetic only (``floor((2·|num|·10^s + |den|) / (2·|den|))``),
    so any engine following the same formula returns the same digits.
    """
    f = 10 ** scale
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    top = F.abs(n) * F.lit(2 * f) + F.abs(d)
    bot = F.abs(d) * F.lit(2)
    q = ((top - top % bot) / bot).cast("decimal(38,0)")
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal({scale + 1},{scale})")
    return F.when(d != 0, (signed.cast("decimal(18,0)") * unit).cast(f"decimal(18,{scale})"))


def ratio(num: str | Column, den: str | Column, scale: int = 4, pct: bool = False) -> Column:
    """``num / den`` (times 100 with ``pct``) for counts, exactly rounded
    HALF_UP to ``scale`` decimals; NULL when ``den`` is 0."""
    n = as_col(num).cast("decimal(38,0)")
    if pct:
        n = n * F.lit(100)
    return half_up_div(n, as_col(den), scale)


def avg_exact(c: str | Column, in_scale: int = 2, out_scale: int = 2) -> Column:
    """``AVG(c)`` rounded HALF_UP to ``out_scale`` decimals, from the exact sum
    of ``c · 10^in_scale`` (``c`` has at most ``in_scale`` decimals)."""
    col = as_col(c).cast(f"decimal(38,{in_scale})")
    s = F.sum((col * F.lit(10 ** in_scale)).cast("decimal(38,0)"))
    return half_up_div(s, F.count(col) * F.lit(10 ** in_scale), out_scale)


def month_start(c: str | Column) -> Column:
    """First day of the month as a DATE (``date_trunc`` would give a TIMESTAMP)."""
    return F.trunc(as_col(c).cast("date"), "month")


def band(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Searched CASE: ``labels[i]`` for values above ``edges[i-1]`` ... first label otherwise.

    ``edges`` ascending, ``len(labels) == len(edges) + 1``; the top band is
    tested first, as in ``CASE WHEN x > hi THEN .. WHEN x > lo THEN .. ELSE ..``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    col = as_col(c)
    expr = None
    for edge, label in sorted(zip(edges, labels[1:]), key=lambda t: -t[0]):
        cond = col > F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[0])) if expr is not None else F.lit(labels[0])


def null_token(c: str | Column, tokens: Iterable[str]) -> Column:
    """Map placeholder strings (compared trimmed, case-insensitive) to NULL."""
    col = as_col(c)
    toks = [t.strip().upper() for t in tokens]
    return F.when(F.upper(F.trim(col)).isin(toks), F.lit(None).cast("string")).otherwise(col)


def canonical(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace known variants (matched on ``lower(trim(x))``) by their canonical value.

    The mapping becomes a literal map inside the expression: no join, no
    shuffle, size fixed by the caller's dictionary.
    """
    col = as_col(c)
    if not mapping:
        return col
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k.strip().lower()), F.lit(v)]
    lookup = F.create_map(*kv)
    return F.coalesce(F.try_element_at(lookup, F.lower(F.trim(col))), col)


def scalar_lit(one: "DataFrame") -> Column:
    """Evaluate a one-row, one-column aggregate (e.g. ``max(ts)``) now and
    return it as a typed literal.

    A bound used in a range filter should be a literal: the filter then
    reaches the parquet scan (``PushedFilters``, row-group skipping), and
    the value is computed once, whereas a scalar subquery is re-run for each
    copy of the predicate. The value travels as text so a wall-clock
    timestamp cannot shift with the Python or session time zone.
    """
    field = one.schema.fields[0]
    row = one.first()
    v = None if row is None else row[0]
    return F.lit(None if v is None else str(v)).cast(field.dataType)


def within_days(ts: str | Column, days: int, as_of: Column) -> Column:
    """``as_of - days <= ts <= as_of`` (``as_of`` explicit so results repeat)."""
    t = as_col(ts)
    return (t >= as_of - F.make_dt_interval(F.lit(days))) & (t <= as_of)
