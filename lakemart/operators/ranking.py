"""Row numbers, ranks, latest-row dedup and surrogate keys without hot tasks.

A window with no ``PARTITION BY`` (or one partitioned by a hot key) sends
every row of the frame (or of the key) through one task. Here the rows are
dealt to buckets of consecutive (group, order) keys, so even one group holding
a third of all rows is split over many tasks: bounds come from a sample of the
keys, a narrow pass counts the rows of every bucket, and the last pass sorts
and numbers each bucket in a window of its own and adds what lies before it.

The bounds are literals of the plan, so every pass, and any recompute after a
lost executor, deals a row to the same bucket; nothing is checkpointed. The
frame is read three times before the last pass is over (but for the last only
its key columns) and must give the same rows each time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from lakemart.session import shuffle_partitions

_BUCKET = "_lm_bucket"
# sampled keys per bucket, buckets per shuffle partition, and the most buckets (their bounds travel with the plan)
_SAMPLED, _PER_PARTITION, _MOST_BUCKETS = 16, 4, 65_536
# frames of up to this many rows are sorted in one task; others in buckets of at least the second number on average
_ONE_TASK, _LEAST_ROWS = 200_000, 50_000
# both ways, so that values come back exactly
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


@dataclass(frozen=True)
class _Key:
    """A sort key: its column and direction (ascending: nulls first; descending: nulls last)."""

    expr: Column
    desc: bool = False

    def sort(self) -> Column:
        return F.desc_nulls_last(self.expr) if self.desc else F.asc_nulls_first(self.expr)

    def before(self, mine: Column, other: Column) -> Column:
        """Does value ``mine`` sort before ``other``? Nulls lie below all values."""
        low, high = (other, mine) if self.desc else (mine, other)
        return (low.isNull() & high.isNotNull()) | F.coalesce(low < high, F.lit(False))


def _names(order: Sequence) -> list[tuple[str, bool]]:
    """``"col"`` or ``("col", "desc")`` as (name, descending)."""
    return [(o, False) if isinstance(o, str) else (o[0], o[1].lower() == "desc") for o in order]


def _keys(order: Sequence) -> list[_Key]:
    return [_Key(F.col(f"`{c}`"), d) for c, d in _names(order)]


def _tie_break(df: DataFrame) -> _Key:
    """Spreads rows with equal keys; rows equal in all columns stay together, where any order is right."""
    return _Key(F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                             if not isinstance(f.dataType, (MapType, VariantType))]))


@dataclass(frozen=True)
class _Buckets:
    """Bounds: the first keys of all buckets but the first, in order, as JSON texts and as one literal array."""

    texts: list[str]
    bounds: Column
    keys: list[_Key]

    def number(self) -> Column:
        """How many bounds do not sort after a row's key: a binary search."""
        size = len(self.texts)
        if not size:
            return F.lit(0)

        def reached(at: Column, step: Column) -> Column:
            bound = F.get(self.bounds, at + step - 1)
            before, same = F.lit(False), F.lit(True)
            for i, k in enumerate(self.keys):
                before = before | (same & k.before(k.expr, bound[f"k{i}"]))
                same = same & bound[f"k{i}"].eqNullSafe(k.expr)
            return F.when((at + step <= size) & ~before, at + step).otherwise(at)

        steps = [1 << e for e in range(size.bit_length() - 1, -1, -1)]
        return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), reached)

    def begins(self, bucket: Column, part: int) -> Column:
        """Does the row's group (its first ``part`` keys) equal that of the bound that ``bucket`` begins with?"""
        bound = F.get(self.bounds, bucket - 1)
        return reduce(lambda x, y: x & y, (bound[f"k{i}"].eqNullSafe(k.expr) for i, k in enumerate(self.keys[:part])), F.lit(True))

    def heads(self, part: int) -> list[str | None]:
        """The group that each bucket begins with; None for the first, whose group lies wholly in it or goes on."""
        return [None] + [json.dumps([json.loads(t).get(f"k{i}") for i in range(part)]) for t in self.texts]


def _literal(texts: Sequence[str], ddl: str) -> Column:
    """A literal array of the JSON ``texts`` (folded when the plan is optimised)."""
    return F.from_json(F.lit("[" + ",".join(texts) + "]"), f"array<{ddl}>", _JSON)


def _sampled(df: DataFrame, keys: list[_Key], wanted: int, n: int) -> _Buckets:
    """About ``wanted`` buckets from a sample of the keys; a bounded number of them reaches the driver."""
    rows = df.select(*[k.expr.alias(f"k{i}") for i, k in enumerate(keys)])
    if n > 2 * wanted * _SAMPLED:
        rows = rows.sample(wanted * _SAMPLED / n, 7)
    schema: StructType = rows.schema
    found = rows.orderBy(*[_Key(F.col(f"k{i}"), k.desc).sort() for i, k in enumerate(keys)]).select(
        F.to_json(F.struct("*"), _JSON).alias("t")).collect()
    at = sorted({len(found) * i // wanted for i in range(1, wanted)} - {0})
    texts = [found[i]["t"] for i in at]
    # the first few keys bound the buckets if they tell all bounds apart: then no mass of equal values of them fills one
    values = [json.loads(t) for t in texts]
    few = next((m for m in range(1, len(keys))
                if len({json.dumps([v.get(f"k{i}") for i in range(m)]) for v in values}) == len(values)), len(keys))
    keys, schema = keys[:few], StructType(schema.fields[:few])
    return _Buckets(texts, _literal(texts, schema.simpleString()), keys)


def _dealt(df: DataFrame, keys: list[_Key], wanted: int | None, at_most: int | None, spread: bool) -> _Buckets:
    """Bounds over the keys; equal bounds mean a mass of equal keys, which a tie-break then spreads."""
    none = _Buckets([], F.lit(None), keys)
    if not wanted and at_most is not None and at_most <= _ONE_TASK:
        return none
    n = df.select(F.count(F.lit(1))).first()[0]
    if not wanted and n <= _ONE_TASK:
        return none
    wanted = wanted or min(_MOST_BUCKETS, _PER_PARTITION * shuffle_partitions(df.sparkSession), n // _LEAST_ROWS)
    if wanted == 1:
        return none
    out = _sampled(df, keys, wanted, n)
    if spread and len(set(out.texts)) < len(out.texts):
        out = _sampled(df, [*keys, _tie_break(df)], wanted, n)
    return out


def _offsets(df: DataFrame, buckets: _Buckets, part: int) -> Column:
    """Literal array, one entry a bucket: ``before``, the rows in earlier buckets, and ``carry``, those of them
    that belong to the group (first ``part`` keys) that the bucket begins with.

    A bucket begins with its bound, so the rows that go on into the next
    bucket are those of the next bound's group. One row a bucket reaches the driver.
    """
    b = df.withColumn(_BUCKET, buckets.number())
    tail = F.count_if(buckets.begins(F.col(_BUCKET) + 1, part)) if part else F.lit(0)
    rows = {r[_BUCKET]: r for r in b.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), tail.alias("tail")).collect()}
    heads = buckets.heads(part)
    out, before, carry = [], 0, 0
    for i, head in enumerate(heads):
        tail = rows[i - 1]["tail"] if i - 1 in rows else 0
        carry = 0 if not i else tail + (carry if head == heads[i - 1] else 0)
        out.append(json.dumps({"before": before, "carry": carry}))
        before += rows[i]["n"] if i in rows else 0
    return _literal(out, "struct<before:bigint,carry:bigint>")


def _numbered(df: DataFrame, by: Sequence[str], order: Sequence, out: str, wanted: int | None, rank: bool,
              at_most: int | None, key_rows: DataFrame | None) -> DataFrame:
    keys = _keys(by) + _keys(order)
    window = Window.partitionBy(_BUCKET, *[k.expr for k in keys[:len(by)]]).orderBy(*[k.sort() for k in keys[len(by):]])
    here = (F.rank() if rank else F.row_number()).over(window).cast("bigint")
    dealt = keys
    if key_rows is not None:
        # buckets by the leading keys alone: rows that tie on them share a bucket
        lead = next((i for i, (c, _) in enumerate(_names([*by, *order])) if c not in key_rows.columns), len(keys))
        dealt = keys[:lead]
    narrow = df if key_rows is None else key_rows
    buckets = _dealt(narrow, dealt, wanted, at_most, spread=key_rows is None)
    # the rows that share a number's group: the key's for row numbers within keys, all ties for ranks; a group lies
    # in one bucket if the bounds hold only a part of its keys
    part = len(keys) if rank else len(by)
    part = part if len(buckets.keys) >= part else 0
    if not buckets.texts:
        return df.withColumn(_BUCKET, F.lit(0)).withColumn(out, here).drop(_BUCKET)
    at = F.get(_offsets(narrow, buckets, part), F.col(_BUCKET))
    rows = df.withColumn(_BUCKET, buckets.number())
    # only rows of the group that the bucket begins with continue a group
    carried = F.lit(0).cast("bigint")
    if part:
        carried = F.when((F.col(_BUCKET) > 0) & buckets.begins(F.col(_BUCKET), part), at["carry"]).otherwise(carried)
    if rank:
        # ties that began in an earlier bucket share its rank; the window gives them 1 here
        number = here + at["before"] - carried
    elif by:
        number = here + carried
    else:
        number = here + at["before"]
    return rows.withColumn(out, number).drop(_BUCKET)


def row_number_within(df: DataFrame, by: Sequence[str], order: Sequence, out: str = "rn", num_partitions: int | None = None,
                      at_most: int | None = None, key_rows: DataFrame | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY by ORDER BY order)``, skew-safe.

    ``order`` (names or ``(name, "desc")``) must end in a unique tie-break for
    a deterministic result. With ``by=[]`` this is the global row number.

    Frames of up to 200,000 rows are numbered in one task, others in
    buckets; each row is shuffled once. ``num_partitions`` sets the number of
    buckets. ``at_most``, a known bound of the row count, spares counting a
    small frame. ``key_rows`` is a frame that is cheaper to read and has the
    leading keys of the same rows (such as the source lines of a fact before
    its lookups); bounds and counts then come from it, and the rows are dealt
    by those leading keys.
    """
    return _numbered(df, list(by), order, out, num_partitions, False, at_most, key_rows)


def global_rank(df: DataFrame, order: Sequence, tie_break: Sequence[str] = (),
                method: str = "row_number", out: str = "rank",
                num_partitions: int | None = None, at_most: int | None = None) -> DataFrame:
    """Global ``ROW_NUMBER`` or ``RANK`` over the whole frame (see ``row_number_within``).

    Ties of a ``RANK`` that lie in several buckets take the rank of the first.
    """
    if method == "row_number":
        return row_number_within(df, [], list(order) + [(t, "asc") for t in tie_break], out, num_partitions, at_most)
    if method != "rank":
        raise ValueError(method)
    return _numbered(df, [], order, out, num_partitions, True, at_most, None)


# a key with at most this many rows is sorted in one task, which may spill; others are spread
MAX_ROWS_PER_KEY = 1_000_000


def sequence_within(df: DataFrame, by: Sequence[str], order: Sequence, out: str = "seq",
                    max_rows: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Running sequence number per key (``ROW_NUMBER() OVER (PARTITION BY ..)``).

    Keys are counted first (combined map-side). Where no key has more than
    ``max_rows`` rows this is a plain window: one shuffle, all in the JVM.
    Larger keys alone are numbered by ``row_number_within``.
    """
    by = list(by)
    large = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows).select(
        *[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)])
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*[k.sort() for k in _keys(order)])).cast("bigint")
    if not large.limit(1).count():
        return df.withColumn(out, number)
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & df[b].eqNullSafe(F.col(f"_k{i}"))
    return df.join(large, same, "left_anti").withColumn(out, number).unionByName(
        row_number_within(df.join(large, same, "left_semi"), by, order, out))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   ascending: bool = False) -> DataFrame:
    """Keep one row per key: the last (or first) by ``order``.

    ``ROW_NUMBER() .. = 1`` as an aggregate: ``max_by(row, order)`` is
    combined map-side, so a key with millions of copies reduces to one row
    per task before the shuffle. ``order`` should end in a tie-break.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    ordkey = F.struct(*[F.col(c) for c in order])
    pick = F.min_by(row, ordkey) if ascending else F.max_by(row, ordkey)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def assign_keys(df: DataFrame, key_col: str, order: Sequence, start: int | Column = 0, at_most: int | None = None,
                key_rows: DataFrame | None = None) -> DataFrame:
    """Dense surrogate keys ``start+1, start+2, ..`` in ``order`` (identity column).

    ``start`` may be a scalar subquery (e.g. the current max key of the
    target), so new keys continue from it. ``at_most`` and ``key_rows``: see
    ``row_number_within``.
    """
    out = row_number_within(df, [], order, out="_lm_k", at_most=at_most, key_rows=key_rows)
    s = start if isinstance(start, Column) else F.lit(start)
    return out.withColumn(key_col, (F.col("_lm_k") + s).cast("bigint")).drop("_lm_k")
