"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Operators compute money, ratios and averages as exact DECIMALs. At the
query boundary every DECIMAL column is delivered as DOUBLE on both sides
(Spark cast; ``SELECT * REPLACE (CAST(.. AS DOUBLE))`` around the oracle
SQL; the column names are listed in ``double_columns``, which
``tools/double_columns.py`` writes). Both engines round the same exact
decimal to the nearest double, so the values stay bit-identical while
consumers see plain floating point.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lakemart.plans.double_columns import DOUBLE_COLUMNS

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql)
        return fn
    return deco


def decimals_as_double(df: DataFrame) -> DataFrame:
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def _wrap_fn(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_as_double(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _wrap_sql(name: str, sql: str) -> str:
    cols = DOUBLE_COLUMNS.get(name)
    if not cols:
        return sql
    repl = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS _q"


_LOADED: dict[str, Entry] | None = None


def load_all() -> dict[str, Entry]:
    """All queries, with DECIMAL results delivered as DOUBLE on both sides."""
    global _LOADED
    if _LOADED is None:
        # importing the group modules fills REGISTRY
        from lakemart.plans import conform_q, core, merge_q, quality_q, sales_q, sources_q  # noqa: F401
        _LOADED = {name: Entry(_wrap_fn(e.fn), _wrap_sql(name, e.sql) if e.sql else None)
                   for name, e in REGISTRY.items()}
    return _LOADED
