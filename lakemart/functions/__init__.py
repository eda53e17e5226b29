"""Column-level helpers: every function returns a ``Column`` (JVM-side, codegen)."""

from lakemart.functions.columns import (
    MONEY,
    as_col,
    avg_exact,
    half_up_div,
    band,
    canonical,
    count_when,
    money,
    money_sum,
    month_start,
    null_token,
    ratio,
    scalar_lit,
    within_days,
)

__all__ = [
    "MONEY", "as_col", "avg_exact", "half_up_div", "band", "canonical", "count_when", "money", "money_sum",
    "month_start", "null_token", "ratio", "scalar_lit", "within_days",
]
