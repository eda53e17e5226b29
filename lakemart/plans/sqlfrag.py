"""SQL text fragments of the oracle queries: ratios and averages are divided and rounded by the database itself,
not by the engine's integer formula."""

from __future__ import annotations

from lakemart.plans.tables import SQL_CTES


def half_up(num: str, den: str, scale: int) -> str:
    # the quotient comes as a double; twelve decimal places make it a decimal again, which ROUND takes half up
    return f"CAST(ROUND(CAST(CAST({num} AS DOUBLE) / NULLIF({den}, 0) AS DECIMAL(38,12)), {scale}) AS DECIMAL(18,{scale}))"


def ratio(num: str, den: str, scale: int = 4, pct: bool = False) -> str:
    n = f"CAST({num} AS HUGEINT)" + (" * 100" if pct else "")
    return half_up(f"({n})", f"CAST({den} AS HUGEINT)", scale)


def avg_exact(col: str, in_scale: int = 2, out_scale: int = 2) -> str:
    f = 10 ** in_scale
    s = f"SUM(CAST(CAST({col} AS DECIMAL(38,{in_scale})) * {f} AS HUGEINT))"
    return half_up(s, f"(COUNT({col}) * {f})", out_scale)


def month(col: str) -> str:
    return f"CAST(date_trunc('month', {col}) AS DATE)"


def q(body: str) -> str:
    """Prefix the canonical CTEs. ``body`` may start with ``, name AS (..)``."""
    return "WITH " + SQL_CTES.strip() + "\n" + body.strip()
