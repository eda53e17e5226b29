"""Data-quality checks. Each returns a tidy DataFrame.

Counting checks run as one aggregate over one scan and are then stacked
into one row per column or rule (``inline`` of an array of structs), in
place of one scan per ``UNION ALL`` branch. Key and duplicate checks group
once; referential checks are anti-joins; schema checks read metadata only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import avg_exact, count_when, half_up_div, ratio


def _stack(agg_row: DataFrame, items: Sequence[tuple[str, Sequence[tuple[str, Column]]]]) -> DataFrame:
    """Turn one aggregate row into one row per item: ``[(label, [(field, expr)])]``."""
    structs = [F.struct(F.lit(label).alias("column_name"), *[e.alias(n) for n, e in fields])
               for label, fields in items]
    return agg_row.select(F.inline(F.array(*structs)))


def _str(c: Column) -> Column:
    return c.cast("string")


# Q1
def profile(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values, min and max (as text).

    ``approx=True`` (HyperLogLog++ sketches, plain aggregates) computes
    everything in one pass over one scan. Exact distinct counts take a
    second aggregate (``_distinct_counts``), bound once as a scalar map.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"_c{i}"), F.min(F.col(c)).alias(f"_lo{i}"),
                 F.max(F.col(c)).alias(f"_hi{i}")]
    if approx:
        row = df.agg(*aggs, F.struct(*[F.approx_count_distinct(F.col(c)).alias(f"d{i}")
                                       for i, c in enumerate(cols)]).alias("_d"))
    else:
        row = df.agg(*aggs).withColumn("_d", _distinct_counts(df, cols).scalar())
    return _stack(row, [(c, [("n_rows", F.col("_n")),
                             ("n_nulls", F.col("_n") - F.col(f"_c{i}")),
                             ("n_distinct", F.col(f"_d.d{i}").cast("bigint") if approx else _count_of(i)),
                             ("min_value", _str(F.col(f"_lo{i}"))),
                             ("max_value", _str(F.col(f"_hi{i}")))]) for i, c in enumerate(cols)])


# Q2
def null_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: NULL count and NULL % of rows."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    return _stack(row, [(c, [("n_nulls", F.col("_n") - F.col(f"_c{i}")),
                             ("null_pct", ratio(F.col("_n") - F.col(f"_c{i}"), F.col("_n"), 2, pct=True))])
                        for i, c in enumerate(cols)])


# Q3
def distinct_report(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.02) -> DataFrame:
    """Per column distinct count; ``approx`` uses HyperLogLog++ (fixed memory)."""
    if not approx:
        return _stack(_distinct_counts(df, cols), [(c, [("n_distinct", _count_of(i))]) for i, c in enumerate(cols)])
    aggs = [F.approx_count_distinct(F.col(c), rsd).alias(f"_d{i}") for i, c in enumerate(cols)]
    return _stack(df.agg(*aggs), [(c, [("n_distinct", F.col(f"_d{i}").cast("bigint"))])
                                  for i, c in enumerate(cols)])


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def _distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: map ``_d`` from column number to its distinct values, for all columns in one pass.

    Every row gives one narrow cell per column. Whole numbers and dates are
    bits of 64-value words joined with OR, so a dense column takes one group
    per 64 values; other values are told apart by a 128-bit digest. Cells are
    combined map-side before the shuffle.
    """
    cells = []
    for i, c in enumerate(cols):
        v, t = F.col(f"`{c}`"), df.schema[c].dataType
        if isinstance(t, _WHOLE):
            v = F.unix_date(v) if isinstance(t, T.DateType) else v
            v = v.cast("bigint")
            a, b = F.shiftright(v, 6), F.lit(0).cast("bigint")
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), v.bitwiseAND(F.lit(63)).cast("int"))
        else:
            # hashed as they are stored; floating point anywhere inside needs its zeros made equal
            exact = v + F.lit(0.0).cast(t) if isinstance(t, (T.DoubleType, T.FloatType)) else \
                _exact(v, t) if isinstance(t, (T.ArrayType, T.StructType, T.MapType)) else v
            a, b, bit = F.xxhash64(exact), F.xxhash64(F.lit(i), exact), F.lit(1).cast("bigint")
        cells.append(F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(i).alias("c"), a.alias("a"), b.alias("b"), bit.alias("bit"))))
    words = df.select(F.explode(F.array(*cells)).alias("x")).where("x is not null").groupBy("x.c", "x.a", "x.b").agg(
        F.bit_or("x.bit").alias("bits"))
    per = words.groupBy("c").agg(F.sum(F.bit_count("bits")).alias("n"))
    return per.agg(F.map_from_entries(F.collect_list(F.struct("c", "n"))).alias("_d"))


def _count_of(i: int) -> Column:
    return F.coalesce(F.try_element_at(F.col("_d"), F.lit(i)), F.lit(0)).cast("bigint")


# Q4
def completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: non-null count and completeness % (100 − null %)."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    return _stack(row, [(c, [("n_non_null", F.col(f"_c{i}")),
                             ("completeness_pct", ratio(F.col(f"_c{i}"), F.col("_n"), 2, pct=True))])
                        for i, c in enumerate(cols)])


# Q5
def time_coverage(df: DataFrame, ts_cols: Sequence[str]) -> DataFrame:
    """Per timestamp column: non-null count, first, last and span in days."""
    aggs = []
    for i, c in enumerate(ts_cols):
        aggs += [F.count(F.col(c)).alias(f"_c{i}"), F.min(F.col(c)).alias(f"_lo{i}"),
                 F.max(F.col(c)).alias(f"_hi{i}")]
    row = df.agg(*aggs)
    return _stack(row, [(c, [("n_non_null", F.col(f"_c{i}")), ("first_ts", F.col(f"_lo{i}")),
                             ("last_ts", F.col(f"_hi{i}")),
                             ("span_days", F.datediff(F.col(f"_hi{i}"), F.col(f"_lo{i}")).cast("bigint"))])
                        for i, c in enumerate(ts_cols)])


# Q6
def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, keys seen more than once, rows under such keys, max rows per key."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k"))
    return per.agg(F.sum("_k").cast("bigint").alias("total_rows"),
                   F.count(F.lit(1)).alias("unique_keys"),
                   count_when(F.col("_k") > 1).alias("duplicate_keys"),
                   F.sum(F.when(F.col("_k") > 1, F.col("_k")).otherwise(0)).cast("bigint").alias("rows_in_duplicates"),
                   F.max("_k").alias("max_per_key"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "cnt") -> DataFrame:
    """Keys seen more than once, with their row count (``GROUP BY .. HAVING cnt > 1``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


# Q7
def duplicate_rows(df: DataFrame, count_col: str = "n_copies") -> DataFrame:
    """Rows that occur more than once (all columns equal), with their count.

    Rows are counted by digest first; only rows whose digest repeats are
    compared in full.
    """
    seen = df.select(_row_digest(df).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_k")).where("_k > 1")
    same = df.withColumn("_h", _row_digest(df)).join(seen, "_h", "left_semi")
    return same.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def _exact(v: Column, t: T.DataType) -> Column:
    """A value that equals another's exactly if DISTINCT takes them for the same.

    Times keep their microseconds (time zones aside), -0.0 becomes 0.0, NaN is
    one value; inside arrays, structs and maps too.
    """
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return (v + F.lit(0.0).cast(t)).cast("string")
    if isinstance(t, T.TimestampType):
        return F.unix_micros(v).cast("string")
    if isinstance(t, T.BinaryType):
        return F.hex(v)
    if isinstance(t, T.ArrayType):
        return F.transform(v, lambda x: _exact(x, t.elementType))
    if isinstance(t, T.StructType):
        return F.when(v.isNotNull(), F.struct(*[_exact(v[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(t.fields)]))
    if isinstance(t, T.MapType):
        return F.array_sort(F.transform(F.map_entries(v), lambda e: F.struct(
            _exact(e["key"], t.keyType).alias("k"), _exact(e["value"], t.valueType).alias("v"))))
    return v.cast("string")


def _row_digest(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """256-bit digest of a row's exact values (nulls and column borders count)."""
    row = F.struct(*[_exact(F.col(f"`{c}`"), df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(cols or df.columns)])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def file_fingerprints(df: DataFrame, file_col: str) -> DataFrame:
    """``file, n_rows, fingerprint``: equal for files that hold the same rows the same number of times, in any order.

    The fingerprint is the row count and two sums of halves of the rows'
    256-bit digests. Sums are combined map-side: a file of any size becomes
    one row a task. A null file name is a file of its own.
    """
    h = _row_digest(df, [c for c in df.columns if c != file_col])
    half = lambda i: F.sum(F.conv(F.substring(h, 15 * i + 1, 15), 16, 10).cast("decimal(38,0)"))
    per = df.groupBy(F.col(f"`{file_col}`").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), half(0).alias("_a"), half(1).alias("_b"))
    return per.select("file", "n_rows", F.concat_ws(":", "n_rows", "_a", "_b").alias("fingerprint"))


def reloaded_files(df: DataFrame, file_col: str) -> DataFrame:
    """Files whose rows all came before under another name: ``file, same_as, n_rows``.

    ``same_as`` is the first (by name) of the files with the same rows; that
    one itself is not listed.
    """
    f = file_fingerprints(df, file_col)
    first = f.groupBy("fingerprint").agg(F.min("file").alias("same_as"), F.count(F.lit(1)).alias("_k")).where("_k > 1")
    return f.join(first, "fingerprint").where("file <> same_as").select("file", "same_as", "n_rows")


# Q8
def referential_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                      relation: str) -> DataFrame:
    """NULL foreign keys and orphans (non-null keys with no parent): one row."""
    # pre-aggregate the child keys: a hot key becomes one row before any shuffle
    ck = child.groupBy(F.col(child_key).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    pk = parent.select(F.col(parent_key).alias("_pk")).distinct()
    orphans = ck.where(F.col("_fk").isNotNull()).join(pk, F.col("_fk") == F.col("_pk"), "left_anti")
    nulls = ck.agg(F.sum("_n").cast("bigint").alias("n_rows"),
                   F.coalesce(F.sum(F.when(F.col("_fk").isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
                   .alias("n_null_keys"))
    return nulls.select(F.lit(relation).alias("relation"), "n_rows", "n_null_keys",
                        orphans.select(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint")).scalar().alias("n_orphans"))


# Q9, Q12, Q21 (wide or long)
def rule_counts(df: DataFrame, rules: Mapping[str, Column], long: bool = True) -> DataFrame:
    """Rows matching each named predicate (NULL comparisons count as not matching).

    ``long=True``: one row per rule (``rule``, ``n_rows``, ``n_matching``);
    otherwise one wide row.
    """
    names = list(rules)
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[count_when(p).alias(f"_r{i}") for i, p in enumerate(rules.values())])
    if not long:
        return row.select(F.col("_n").alias("total_rows"), *[F.col(f"_r{i}").alias(n) for i, n in enumerate(names)])
    out = _stack(row, [(n, [("n_rows", F.col("_n")), ("n_matching", F.col(f"_r{i}"))])
                       for i, n in enumerate(names)])
    return out.withColumnRenamed("column_name", "rule")


def timestamp_sanity(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return rule_counts(df, rules, long=True)


def range_check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return rule_counts(df, rules, long=True)


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return rule_counts(df, rules, long=True).withColumnRenamed("n_matching", "n_violations")


# Q10
def string_lengths(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per text column: min, max and mean length in characters."""
    aggs = []
    for i, c in enumerate(cols):
        ln = F.length(F.col(c))
        aggs += [F.min(ln).cast("bigint").alias(f"_lo{i}"), F.max(ln).cast("bigint").alias(f"_hi{i}"),
                 avg_exact(ln, 0, 2).alias(f"_av{i}")]
    return _stack(df.agg(*aggs), [(c, [("min_len", F.col(f"_lo{i}")), ("max_len", F.col(f"_hi{i}")),
                                       ("avg_len", F.col(f"_av{i}"))]) for i, c in enumerate(cols)])


# Q11
def domain_check(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Frequency and % per value, flagged against the allowed set."""
    agg = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    agg = agg.withColumn("_lm_total", agg.select(F.sum("n")).scalar())
    return agg.select("value", "n", ratio(F.col("n"), F.col("_lm_total"), 2, pct=True).alias("pct"),
                      F.coalesce(F.col("value").isin(list(allowed)), F.lit(False)).alias("is_allowed"))


# Q14
def duration_stats(df: DataFrame, start: str, end: str) -> DataFrame:
    """Days from ``start`` to ``end``: count, min, max, mean, sample stddev."""
    d = F.datediff(F.col(end), F.col(start))
    return df.select(d.alias("_d")).agg(
        F.count("_d").alias("n"), F.min("_d").cast("bigint").alias("min_days"),
        F.max("_d").cast("bigint").alias("max_days"), avg_exact(F.col("_d"), 0, 4).alias("avg_days"),
        F.round(F.stddev_samp("_d"), 6).alias("stddev_days"))


def duration_hours(df: DataFrame, start: str, end: str) -> DataFrame:
    """Hours from ``start`` to ``end`` (seconds between the two / 3600): count,
    min, max and mean to two decimals. ``timestamp_diff`` on wall-clock
    timestamps, so the session time zone cannot shift a difference."""
    sec = F.timestamp_diff("SECOND", F.col(start), F.col(end))
    return df.select(sec.alias("_s")).agg(
        F.count("_s").alias("n"),
        half_up_div(F.min("_s"), F.lit(3600), 2).alias("min_hours"),
        half_up_div(F.max("_s"), F.lit(3600), 2).alias("max_hours"),
        half_up_div(F.sum("_s"), F.count("_s") * F.lit(3600), 2).alias("avg_hours"))


def delivery_performance(df: DataFrame, delivered: str, estimated: str) -> DataFrame:
    """Delivered rows: on time (delivered <= estimate), late, on-time % and mean
    days against the estimate (one decimal, HALF_UP)."""
    d = df.where(F.col(delivered).isNotNull() & F.col(estimated).isNotNull())
    days = F.datediff(F.col(delivered), F.col(estimated))
    return d.agg(F.count(F.lit(1)).alias("total_delivered"),
                 count_when(F.col(delivered) <= F.col(estimated)).alias("on_time"),
                 count_when(F.col(delivered) > F.col(estimated)).alias("late"),
                 avg_exact(days, 0, 1).alias("avg_days_vs_estimate")) \
        .withColumn("on_time_pct", ratio(F.col("on_time"), F.col("total_delivered"), 2, pct=True))


def on_time_report(status: DataFrame, label: str = "delivery_status") -> DataFrame:
    """Orders per delivery label with its share."""
    agg = status.groupBy(label).agg(F.count(F.lit(1)).alias("n_orders"))
    agg = agg.withColumn("_lm_total", agg.select(F.sum("n_orders")).scalar())
    return agg.withColumn("pct", ratio(F.col("n_orders"), F.col("_lm_total"), 2, pct=True)).drop("_lm_total")


# Q15, Q16
# cells of a bracket, and the rows in brackets up to which values are counted one by one
_CELLS, _FEW = 1024, 50_000


def _at_ranks(v: DataFrame, n: int, ranks: Sequence[int], brackets: list[tuple[float, float]]) -> dict[int, float]:
    """The finite values of column ``_v`` at 0-based ``ranks``, by histograms that narrow brackets around them.

    Each round maps every value to one of ordered cells (``_CELLS`` a bracket,
    one for each gap between brackets), counts them in one aggregate, and
    makes the cells that hold a rank, with the least and greatest value found
    in them, the next brackets. A cell of one value is an answer. No value is
    sorted or numbered; at most ``_CELLS`` rows a bracket reach the driver.
    """
    out: dict[int, float] = {}
    todo, before = sorted(set(ranks)), None
    rows_inside = n
    while todo:
        spans: list[list[float]] = []
        for lo, hi in sorted(brackets):
            if spans and lo <= spans[-1][1]:
                spans[-1][1] = max(hi, spans[-1][1])
            else:
                spans.append([lo, hi])
        x, cell, inside = F.col("_v"), None, None
        for i, (lo, hi) in enumerate(spans):
            base = i * (_CELLS + 2)
            part = 1.0 if hi - lo < float("inf") else 0.5  # a width beyond the largest double is taken in halves
            step = F.least(F.floor((x * part - lo * part) / (hi * part - lo * part) * _CELLS), F.lit(_CELLS - 1)) if lo < hi else F.lit(0)
            cell = (F.when if cell is None else cell.when)(x < lo, F.lit(base)).when(x <= hi, step.cast("int") + base + 1)
            here = (x >= lo) & (x <= hi)
            inside = here if inside is None else inside | here
        cell = cell.otherwise(F.lit(len(spans) * (_CELLS + 2)))
        # few rows inside, or brackets too narrow for cells to divide them: the values themselves are the cells
        key = F.when(inside, x) if rows_inside <= _FEW or spans == before else F.lit(None).cast("double")
        before = spans
        found = v.groupBy(cell.alias("_cell"), key.alias("_key")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi")).collect()
        found.sort(key=lambda r: (r["_cell"], r["lo"]))
        below, rest, brackets, rows_inside = 0, [], [], 0
        todo_at = iter(todo)
        rank = next(todo_at, None)
        for r in found:
            if rank is not None and rank < below + r["n"]:
                if r["lo"] == r["hi"]:
                    while rank is not None and rank < below + r["n"]:
                        out[rank] = r["lo"]
                        rank = next(todo_at, None)
                else:
                    brackets.append((r["lo"], r["hi"]))
                    rows_inside += r["n"]
                    while rank is not None and rank < below + r["n"]:
                        rest.append(rank)
                        rank = next(todo_at, None)
            below += r["n"]
        todo = rest
    return out


def quantile_values(df: DataFrame, col: str, ps: Sequence[float], accuracy: int = 10000) -> list[float | None]:
    """Exact interpolated quantiles (as ``percentile`` / ``quantile_cont``), None without values.

    A sketch brackets each quantile (its rank error is at most 1/accuracy),
    then histograms find the rows around it (``_at_ranks``): two scans where
    the brackets hold few rows, one more per factor of a thousand. NaN is the
    greatest value.
    """
    v = df.select(F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    fine = F.when(~F.isnan("_v") & (F.abs("_v") < float("inf")), F.col("_v"))
    probs = sorted({min(1.0, max(0.0, p + s)) for p in ps for s in (-2.5 / accuracy, 2.5 / accuracy)})
    one = v.agg(F.count_if(F.col("_v") == float("-inf")).alias("low"), F.count(fine).alias("n"), F.count_if(F.col("_v") == float("inf")).alias("high"),
                F.count_if(F.isnan("_v")).alias("nan"), F.min(fine).alias("lo"), F.max(fine).alias("hi"),
                F.percentile_approx(fine, probs, accuracy).alias("at")).first()
    total = one["low"] + one["n"] + one["high"] + one["nan"]
    if not total:
        return [None] * len(ps)
    places = [(total - 1) * float(p) for p in ps]
    ranks = {f(x) for x in places for f in (math.floor, math.ceil)}
    known = {r: float("-inf") for r in ranks if r < one["low"]}
    known |= {r: float("inf") if r < total - one["nan"] else float("nan") for r in ranks if r >= one["low"] + one["n"]}
    left = [r - one["low"] for r in sorted(ranks - set(known))]
    if left:
        bounds = [one["lo"], *(one["at"] or []), one["hi"]]
        edges = [0.0, *probs, 1.0]
        brackets = []
        for r in left:
            share = r / one["n"]
            # the sketch's values on both sides of the rank, one error and two rows away
            slack = 1.0 / accuracy + 2 / one["n"]
            lo = max((i for i, e in enumerate(edges) if e <= share - slack), default=0)
            hi = min((i for i, e in enumerate(edges) if e >= share + slack), default=len(edges) - 1)
            brackets.append((bounds[lo], bounds[hi]))
        inside = min(one["n"], int(one["n"] * 6 / accuracy) * len(set(brackets)) + 100) if one["n"] > accuracy else one["n"]
        finite = v.where(~F.isnan("_v") & (F.abs("_v") < float("inf")))
        found = _at_ranks(finite, inside, left, brackets)
        known |= {r + one["low"]: x for r, x in found.items()}

    def between(x: float) -> float:
        low, high, part = known[math.floor(x)], known[math.ceil(x)], x - math.floor(x)
        return low if low == high else low + (high - low) * part

    return [between(x) for x in places]


def exact_quantiles(df: DataFrame, col: str, ps: Sequence[float], accuracy: int = 10000) -> Column:
    """``quantile_values`` as one literal struct ``q0, q1, ..``."""
    return F.struct(*[F.lit(q).cast("double").alias(f"q{i}") for i, q in enumerate(quantile_values(df, col, ps, accuracy))])


def distribution(df: DataFrame, col: str, exact: bool = True, accuracy: int = 10000) -> DataFrame:
    """Quartiles, mean, sample stddev, population skewness and excess kurtosis.

    ``exact`` interpolates quartiles between the rows around them (see
    ``quantile_values``); ``exact=False`` uses ``percentile_approx`` (a
    fixed-size sketch merged map-side: one pass, no sort).
    """
    c = F.col(col).cast("double")
    moments = [F.count(c).alias("n"),
               F.round(F.avg(c), 6).alias("mean"), F.round(F.stddev_samp(c), 6).alias("stddev"),
               F.round(F.skewness(c), 6).alias("skewness"), F.round(F.kurtosis(c), 6).alias("kurtosis")]
    if not exact:
        qa = F.percentile_approx(c, [0.25, 0.5, 0.75], accuracy)
        return df.agg(*moments, qa.alias("_qa")).select(
            "n", *[F.round(F.col("_qa")[i].cast("double"), 6).alias(nm) for i, nm in enumerate(("p25", "p50", "p75"))],
            "mean", "stddev", "skewness", "kurtosis")
    out = df.agg(*moments).withColumn("_q", exact_quantiles(df, col, (0.25, 0.5, 0.75)))
    return out.select("n", *[F.round(F.col(f"_q.q{i}"), 6).alias(nm) for i, nm in enumerate(("p25", "p50", "p75"))],
                      "mean", "stddev", "skewness", "kurtosis")


def iqr_outliers(df: DataFrame, col: str, exact: bool = True, k: float = 1.5) -> DataFrame:
    """Tukey fences ``q1 − k·iqr`` and ``q3 + k·iqr``; counts below and above."""
    if exact:
        q = exact_quantiles(df, col, (0.25, 0.75))
    else:
        qa = df.agg(F.percentile_approx(F.col(col).cast("double"), [0.25, 0.75], 10000).alias("qa"))
        q = qa.select(F.struct(F.col("qa")[0].cast("double").alias("q0"),
                               F.col("qa")[1].cast("double").alias("q1"))).scalar()
    # quartiles bound once as a column, fences derived from it
    x = df.select(F.col(col).cast("double").alias("_v")).withColumn("_q", q)
    q1, q3 = F.col("_q.q0"), F.col("_q.q1")
    x = x.withColumn("_lo", q1 - (q3 - q1) * k).withColumn("_hi", q3 + (q3 - q1) * k)
    counts = x.agg(count_when(F.col("_v") < F.col("_lo")).alias("n_below"),
                   count_when(F.col("_v") > F.col("_hi")).alias("n_above"), F.count("_v").alias("n"),
                   F.first("_q").alias("_q"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    return counts.select(F.round(F.col("_q.q0"), 6).alias("q1"), F.round(F.col("_q.q1"), 6).alias("q3"),
                         F.round(F.col("_lo"), 6).alias("lower_fence"), F.round(F.col("_hi"), 6).alias("upper_fence"),
                         "n", "n_below", "n_above")


# Q17
def duplication_rate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct rows, surplus copies and their % of rows, in all or per ``by``
    (such as the file name, which shows a file loaded twice).

    Rows are told apart by a 256-bit digest, so no text is shuffled.
    """
    cols = [c for c in df.columns if c not in by]
    per = df.groupBy(*by, _row_digest(df, cols).alias("_h")).agg(F.count(F.lit(1)).alias("_k"))
    return per.groupBy(*by).agg(F.coalesce(F.sum("_k"), F.lit(0)).cast("bigint").alias("total_rows"),
                                F.count(F.lit(1)).alias("distinct_rows")) \
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows")) \
        .withColumn("duplicate_pct", ratio(F.col("duplicate_rows"), F.col("total_rows"), 2, pct=True))


# Q18
def freshness(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    """Earliest, latest, whole days since the latest, rows dated after ``as_of``."""
    return df.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"),
                  count_when(F.col(ts) > as_of).alias("future_rows")) \
        .withColumn("days_since_last", F.datediff(as_of, F.col("latest")).cast("bigint"))


# Q19
def per_key_cardinality(df: DataFrame, key: str, attr: str) -> DataFrame:
    """Keys with several ``attr`` values; min / max / mean rows per key (two-level aggregate)."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.count_distinct(attr).alias("_v"))
    return per.agg(F.count(F.lit(1)).alias("n_keys"), count_when(F.col("_v") > 1).alias("keys_with_multiple"),
                   F.min("_n").alias("min_per_key"), F.max("_n").alias("max_per_key"),
                   avg_exact(F.col("_n"), 0, 4).alias("avg_per_key"))


# Q20
def empty_periods(df: DataFrame, ts: str, grain: str = "day") -> DataFrame:
    """Periods between the first and the last row that hold no row, with ``n_rows`` 0.

    The calendar between both ends bounds the periods, whatever the data volume.
    """
    full = volume(df, ts, grain)
    ends = full.agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    step = F.expr(f"INTERVAL 1 {'DAY' if grain == 'day' else 'MONTH'}")
    every = ends.where("lo is not null").select(F.explode(F.sequence("lo", "hi", step)).alias("period"))
    return every.join(full, "period", "left_anti").withColumn("n_rows", F.lit(0).cast("bigint"))


def volume(df: DataFrame, ts: str, grain: str = "day", by: Sequence[str] = (),
           expected: Column | float | None = None) -> DataFrame:
    """Row count per day or month (DATE of the period start), optionally by keys.

    With ``expected`` (a number, or ``"mean"`` for the mean count per period
    as a scalar subquery) each period also gets ``expected`` and
    ``deviation_pct`` = 100·(n − expected)/expected.
    """
    period = F.col(ts).cast("date") if grain == "day" else F.trunc(F.col(ts).cast("date"), grain)
    out = df.groupBy(period.alias("period"), *by).agg(F.count(F.lit(1)).alias("n_rows"))
    if expected is None:
        return out
    if isinstance(expected, str) and expected == "mean":
        exp = out.select(F.sum("n_rows").alias("s"), F.count(F.lit(1)).alias("c")) \
            .select(half_up_div(F.col("s"), F.col("c"), 2)).scalar()
    else:
        exp = F.lit(expected).cast("decimal(18,2)")
    out = out.withColumn("expected", exp)  # bound once
    e = F.col("expected")
    dev = half_up_div(((F.col("n_rows") - e) * 10000).cast("decimal(38,0)"), (e * 100).cast("decimal(38,0)"), 2)
    return out.withColumn("deviation_pct", dev)


# Q22
def sequence_validity(df: DataFrame, chain: Sequence[str]) -> DataFrame:
    """For each step ``a -> b`` of the timestamp chain: rows in order (a <= b),
    out of order (a > b) and with a missing end; plus the fully valid chain.
    A NULL on either side counts as neither valid nor invalid."""
    steps = list(zip(chain, chain[1:]))
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, (a, b) in enumerate(steps):
        aggs += [count_when(F.col(a) <= F.col(b)).alias(f"_v{i}"), count_when(F.col(a) > F.col(b)).alias(f"_x{i}"),
                 count_when(F.col(a).isNull() | F.col(b).isNull()).alias(f"_m{i}")]
    all_ok = None
    for a, b in steps:
        e = F.col(a) <= F.col(b)
        all_ok = e if all_ok is None else all_ok & e
    aggs.append(count_when(all_ok).alias("_all"))
    row = df.agg(*aggs)
    items = [(f"{a}->{b}", [("n_valid", F.col(f"_v{i}")), ("n_invalid", F.col(f"_x{i}")),
                            ("n_missing", F.col(f"_m{i}"))]) for i, (a, b) in enumerate(steps)]
    items.append(("chain", [("n_valid", F.col("_all")), ("n_invalid", F.col("_n") - F.col("_all")),
                            ("n_missing", F.lit(None).cast("bigint"))]))
    return _stack(row, items).withColumnRenamed("column_name", "step")


# Q23
def total_consistency(parent: DataFrame, child: DataFrame, key: str, total: str, part: str,
                      tolerance: float = 0.0) -> DataFrame:
    """Parent totals against the sum of their parts (aggregate of aggregate).

    Keys on one side only are counted too: parents without parts and parts
    without a parent. A null total or sum is neither consistent nor not.
    """
    parts = child.groupBy(key).agg(F.sum(part).alias("_parts"), F.lit(1).alias("_has_parts"))
    j = parent.select(key, total, F.lit(1).alias("_has_total")).join(parts, key, "full_outer")
    diff = F.abs(F.col(total) - F.col("_parts"))
    return j.agg(F.count(F.lit(1)).alias("n_keys"),
                 F.count(F.when(diff <= F.lit(tolerance), 1)).alias("n_consistent"),
                 F.count(F.when(diff > F.lit(tolerance), 1)).alias("n_inconsistent"),
                 F.count(F.when(F.col("_has_parts").isNull(), 1)).alias("n_without_parts"),
                 F.count(F.when(F.col("_has_total").isNull(), 1)).alias("n_without_parent"),
                 F.max(diff).alias("max_abs_diff"))


def parts_match_total(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """One row: all rows against the sum of the counts of the listed values, Match or Mismatch."""
    row = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count(F.when(F.col(col).isin(list(values)), 1)).alias("sum_of_parts"))
    return row.withColumn("result", F.when(F.col("total_rows") == F.col("sum_of_parts"), "Match").otherwise("Mismatch"))


# Q24
def run_suite(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (),
              expressions: Mapping[str, Column] | None = None) -> DataFrame:
    """dbt-style tests → one row per test: test, target, failures, status (pass/fail).

    not_null and expression tests share one scan; each unique test groups once.
    """
    expressions = dict(expressions or {})
    rows = []
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_nn{i}") for i, c in enumerate(not_null)]
    aggs += [F.count_if(~F.coalesce(e, F.lit(False))).alias(f"_ex{i}") for i, e in enumerate(expressions.values())]
    if aggs:
        one = df.agg(*aggs)
        items = [F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("target"), F.col(f"_nn{i}").alias("failures"))
                 for i, c in enumerate(not_null)]
        items += [F.struct(F.lit("expression_is_true").alias("test"), F.lit(n).alias("target"),
                           F.col(f"_ex{i}").alias("failures")) for i, n in enumerate(expressions)]
        rows.append(one.select(F.inline(F.array(*items))))
    for keys in unique:
        keys = list(keys)
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > 1)
               .agg(F.coalesce(F.sum("_k"), F.lit(0)).cast("bigint").alias("failures")))
        rows.append(dup.select(F.lit("unique").alias("test"), F.lit(",".join(keys)).alias("target"), "failures"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


# Q25
def pattern_check(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Per column: non-null values and those not matching the regular expression."""
    cols = list(patterns)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"_c{i}"),
                 count_when(F.col(c).isNotNull() & ~F.col(c).rlike(patterns[c])).alias(f"_b{i}")]
    return _stack(df.agg(*aggs), [(c, [("n_checked", F.col(f"_c{i}")), ("n_invalid", F.col(f"_b{i}"))])
                                  for i, c in enumerate(cols)])


# Q26
def geo_check(df: DataFrame, lat: str, lon: str, bbox: tuple[float, float, float, float]) -> DataFrame:
    """Coordinates: missing, zero, out of range, outside the box, swapped (lat/lon fit the box reversed)."""
    la, lo = F.col(lat), F.col(lon)
    s, w, n, e = bbox
    inside = la.between(s, n) & lo.between(w, e)
    swapped = lo.between(s, n) & la.between(w, e) & ~inside
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  count_when(la.isNull() | lo.isNull()).alias("n_missing"),
                  count_when((la == 0) | (lo == 0)).alias("n_zero"),
                  count_when((F.abs(la) > 90) | (F.abs(lo) > 180)).alias("n_out_of_range"),
                  count_when(la.isNotNull() & lo.isNotNull() & ~inside).alias("n_outside_box"),
                  count_when(swapped).alias("n_swapped"))


# Q27
def castability(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Per column: non-null values that do not convert to the target type."""
    cols = list(targets)
    aggs = [count_when(F.col(c).isNotNull() & F.col(c).try_cast(targets[c]).isNull()).alias(f"_b{i}")
            for i, c in enumerate(cols)]
    return _stack(df.agg(*aggs), [(c, [("target_type", F.lit(targets[c])), ("n_uncastable", F.col(f"_b{i}"))])
                                  for i, c in enumerate(cols)])


# Q13, S10 — metadata only
def schema_report(df: DataFrame) -> DataFrame:
    """column_name, data_type, ordinal of a frame's schema."""
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, ordinal int")


def table_info(df: DataFrame) -> DataFrame:
    """One row: row count, column count and the column names joined into one
    string in schema order (``ARRAY_JOIN(ARRAY_AGG(name), ', ')``)."""
    names = schema_report(df).agg(
        F.count(F.lit(1)).alias("total_columns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "column_name"))),
                                 lambda x: x["column_name"]), ", ").alias("column_names"))
    return names.withColumn("total_rows", df.select(F.count(F.lit(1))).scalar()) \
        .select("total_rows", "total_columns", "column_names")


def schema_drift(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Expected vs actual type per column; issue = ok / type_mismatch / missing / unexpected."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name, t in expected.items():
        a = actual.get(name)
        issue = "missing" if a is None else ("ok" if a == t else "type_mismatch")
        rows.append((name, t, a, issue))
    for name, a in actual.items():
        if name not in expected:
            rows.append((name, None, a, "unexpected"))
    schema = "column_name string, expected_type string, actual_type string, issue string"
    return df.sparkSession.createDataFrame(rows, schema)
