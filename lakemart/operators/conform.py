"""Conforming raw (bronze) tables into typed (silver) ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakemart.functions.columns import canonical, null_token, within_days
from lakemart.operators.ranking import latest_per_key


@dataclass(frozen=True)
class Field:
    """One target column: ``source`` column, target ``type``, optional
    case folding (``lower``/``upper``/``trim``) and timestamp ``fmt``."""
    name: str
    source: str
    type: str = "string"
    fold: str | None = None
    fmt: str | None = None


def _fold(c: Column, fold: str | None) -> Column:
    if fold is None:
        return c
    return {"lower": F.lower, "upper": F.upper, "trim": F.trim}[fold](c)


def conform(df: DataFrame, spec: Sequence[Field], on_error: str = "null",
            errors_col: str = "_conform_errors") -> DataFrame:
    """Rename, cast, case-fold and parse timestamps in one projection.

    ``on_error``: ``"null"`` turns unparsable values into NULL (``try_*``),
    ``"raise"`` fails the job on the first bad value (ANSI cast), and
    ``"report"`` keeps NULLs and adds ``errors_col``, the names of the
    fields whose non-null source value did not convert.
    """
    if on_error not in ("null", "raise", "report"):
        raise ValueError(on_error)
    out, failed = [], []
    for f in spec:
        src = F.col(f.source)
        is_str = isinstance(df.schema[f.source].dataType, StringType)
        val = _fold(src, f.fold) if is_str else src
        t = f.type.lower()
        if t == "string":
            conv = val.cast("string")
        elif t in ("timestamp", "timestamp_ntz") and is_str:
            # parse in the session zone, then keep the wall-clock value if NTZ
            fmt = F.lit(f.fmt) if f.fmt else None
            if on_error == "raise":
                conv = F.to_timestamp(val, f.fmt) if f.fmt else val.cast("timestamp")
            else:
                conv = F.try_to_timestamp(val, fmt) if fmt is not None else val.try_cast("timestamp")
            conv = conv.cast(t)
        else:
            conv = val.cast(t) if on_error == "raise" else val.try_cast(t)
        out.append(conv.alias(f.name))
        failed.append(F.when(src.isNotNull() & conv.isNull(), F.lit(f.name)))
    res = df.select(*out, *([F.filter(F.array(*failed), lambda x: x.isNotNull()).alias(errors_col)]
                            if on_error == "report" else []))
    return res


def normalise_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Staging view: ``UPPER(TRIM(col))`` on the chosen columns."""
    return df.select(*[F.upper(F.trim(F.col(c))).alias(c) if c in cols else F.col(c) for c in df.columns])


DEFAULT_NULL_TOKENS = ("", "N/A", "NULL", "UNKNOWN", "TBC")


def null_tokens(df: DataFrame, cols: Sequence[str], tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Placeholder strings (trimmed, any case) become real NULLs."""
    return df.select(*[null_token(c, tokens).alias(c) if c in cols else F.col(c) for c in df.columns])


def canonicalise(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None) -> DataFrame:
    """Replace spelling/case variants of ``col`` by canonical values."""
    return df.withColumn(out or col, canonical(col, mapping))


def stage_events(df: DataFrame, rules: Mapping[str, tuple], key: Sequence[str], order: Sequence[str],
                 ts: str, as_of: Column, text_cols: Sequence[str] = ()) -> DataFrame:
    """Staging: trim/upper text, keep rows inside every ``(lo, hi)`` range,
    drop future rows (``ts > as_of``), then the latest row per key."""
    cond = F.col(ts) <= as_of
    for c, (lo, hi) in rules.items():
        cond = cond & F.col(c).between(lo, hi)
    staged = normalise_text(df, list(text_cols)).where(cond)
    return latest_per_key(staged, key, order)


def within_last(df: DataFrame, ts: str, days: int, as_of: Column) -> DataFrame:
    """Rows from the last ``days`` days up to ``as_of``."""
    return df.where(within_days(ts, days, as_of))
