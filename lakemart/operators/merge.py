"""Upserts and slowly changing dimensions as snapshot functions.

Plain parquet has no MERGE or UPDATE, so each operator is a pure function
``(target, changes) -> new target``; the caller writes the result to a new
snapshot path (never over the path being read). One DataFrame plan per
change means no intermediate state in which a key has no current row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.ranking import assign_keys, latest_per_key, row_number_within
from lakemart.session import scratch_path

OPEN_END = "9999-12-31"


def _same(a: str, b: str, cols: Sequence[str]) -> Column:
    """All ``cols`` of aliases ``a`` and ``b`` equal; a NULL key is a key like any other."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once beneath the shared folder, for frames of the size of a change batch that are used often."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# M4
def scd_init(source: DataFrame, kind: int, keys: Sequence[str], tracked: str | Sequence[str],
             effective_col: str, sk_col: str = "SK", current_col: str = "Current",
             previous_col: str = "Previous", date_col: str = "LastUpdatedDate") -> DataFrame:
    """Initial load of an SCD table of type 1, 2 or 3 from a source snapshot."""
    keys = list(keys)
    tracked = [tracked] if isinstance(tracked, str) else list(tracked)
    rest = [c for c in source.columns if c not in keys and c != effective_col]
    eff = F.col(effective_col).cast("date")
    if kind == 1:
        return source.select(*keys, *rest, eff.alias(date_col))
    if kind == 2:
        base = source.select(*keys, *rest, eff.alias("StartDate"),
                             F.lit(OPEN_END).cast("date").alias("EndDate"), F.lit(True).alias("IsCurrent"))
        out = assign_keys(base, sk_col, [(k, "asc") for k in keys])
        return out.select(sk_col, *keys, *rest, "StartDate", "EndDate", "IsCurrent")
    if kind == 3:
        col = tracked[0]
        others = [c for c in rest if c != col]
        return source.select(*keys, *others, F.col(col).alias(current_col),
                             F.lit(None).cast(source.schema[col].dataType).alias(previous_col),
                             eff.alias(date_col))
    raise ValueError(kind)


def one_per_key(df: DataFrame, keys: Sequence[str], what: str = "changes") -> DataFrame:
    """``df``, whose plan fails at run time if a key occurs twice (as MERGE does).

    Counting and picking the row are one map-side combined aggregate.
    """
    rest = [c for c in df.columns if c not in keys]
    per = df.groupBy(*keys).agg(F.first(F.struct(*[F.col(c) for c in rest])).alias("_row"), F.count(F.lit(1)).alias("_n"))
    twice = F.raise_error(F.lit(f"{what}: several rows for one key of {', '.join(keys)}")).cast("boolean")
    return per.where(F.when(F.col("_n") > 1, twice).otherwise(F.lit(True))).select(*keys, "_row.*").select(*df.columns)


# M1
def scd1_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
               effective_col: str, date_col: str = "LastUpdatedDate") -> DataFrame:
    """MERGE: matched keys take the source value of ``update_cols`` (others,
    e.g. the name, keep the target value); unmatched source keys are inserted.

    Several source rows for one key fail the job, as they fail MERGE. A NULL
    key matches a NULL key, so merging a batch again changes nothing.
    """
    keys = list(keys)
    src = one_per_key(source, keys).withColumn(effective_col, F.col(effective_col).cast("date"))
    t, s = target.withColumn("_in_t", F.lit(True)).alias("t"), src.withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, _same("t", "s", keys), "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c == date_col:
            out.append(F.when(in_s, F.col(f"s.{effective_col}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            src_val = F.col(f"s.{c}") if c in src.columns else F.lit(None)
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(src_val).alias(c))
    return j.select(*out)


# a key with at most this many versions in one batch is ordered in one task; others are spread
MAX_VERSIONS_PER_TASK = 10_000


# M2
def scd2_apply(target: DataFrame, changes: DataFrame, keys: Sequence[str], tracked: Sequence[str],
               effective_col: str, sk_col: str = "SK", return_rejects: bool = False):
    """SCD-2: close the current row the day before the change, append the new version.

    * several changes to one key in one batch become consecutive versions
      (each ends the day before the next starts);
    * a change equal to the version before it is skipped, so re-applying a
      batch changes nothing and each key keeps exactly one current row; a
      NULL key is a key like any other;
    * a target row whose ``IsCurrent`` is NULL counts as history and is kept;
    * not applied, and returned with a ``reason`` by ``return_rejects``: a
      change dated on or before the current row's start (``out of order``),
      one without a date (``no date``), and of several changes to one key on
      the same day all but the greatest by attribute values (``same day``).
    """
    keys, tracked = list(keys), list(tracked)
    attrs = [c for c in target.columns if c not in (sk_col, "StartDate", "EndDate", "IsCurrent") and c not in keys]
    ch = changes.select(*keys, *attrs, F.col(effective_col).cast("date").alias("StartDate"))
    is_current = F.coalesce(F.col("IsCurrent"), F.lit(False))
    cur, hist = target.where(is_current), target.where(~is_current)
    # the batch with its verdicts is planned once; all that follows is of its size
    starts = cur.select(*keys, F.col("StartDate").alias("_cur_start")).alias("c")
    reason = F.when(F.col("StartDate").isNull(), "no date").when(F.col("StartDate") <= F.col("_cur_start"), "out of order")
    chk = _kept(ch.alias("n").join(starts, _same("n", "c", keys), "left").select(
        "n.*", reason.alias("reason")), "scd2_batch")
    usable = chk.where("reason is null").drop("reason")
    ok = latest_per_key(usable, keys + ["StartDate"], attrs) if attrs else usable.distinct()
    # one timeline per changed key: its current row followed by the accepted changes
    old = cur.alias("c").join(ok.select(*keys).alias("o"), _same("c", "o", keys), "left_semi")
    versions = (old.select(*keys, *attrs, "StartDate", F.col(sk_col), F.lit(0).alias("_is_new"))
                .unionByName(ok.select(*keys, *attrs, "StartDate", F.lit(None).cast("bigint").alias(sk_col), F.lit(1).alias("_is_new"))))
    n = chk.count()
    long_keys = ok.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MAX_VERSIONS_PER_TASK).select(*keys)
    if n > MAX_VERSIONS_PER_TASK and long_keys.limit(1).count():
        v, k = versions.alias("v"), long_keys.alias("k")
        timeline = _ordered(v.join(k, _same("v", "k", keys), "left_anti"), keys, tracked).unionByName(
            _timeline(v.join(k, _same("v", "k", keys), "left_semi"), keys, tracked), allowMissingColumns=True)
    else:
        timeline = _ordered(versions, keys, tracked)
    timeline = _kept(timeline, "scd2_timeline")
    old_rows = timeline.where(F.col("_is_new") == 0).drop("_is_new")
    new_rows = timeline.where(F.col("_is_new") == 1).drop("_is_new", sk_col)
    # keys without an accepted change keep their current row untouched
    cur_untouched = cur.alias("c").join(old_rows.select(*keys).alias("o"), _same("c", "o", keys), "left_anti")
    max_sk = target.select(F.coalesce(F.max(sk_col), F.lit(0)).cast("bigint")).scalar()
    new_rows = assign_keys(new_rows, sk_col, [(k, "asc") for k in keys] + [("StartDate", "asc")], start=max_sk, at_most=n)
    cols = target.columns
    out = (hist.select(*cols).unionByName(cur_untouched.select(*cols))
           .unionByName(old_rows.select(*cols)).unionByName(new_rows.select(*cols)))
    if not return_rejects:
        return out
    # of several usable changes to one key on one day, all but one copy of the greatest
    used = ok.select(*keys, "StartDate", F.struct(F.lit(1).alias("_one"), *attrs).alias("_best")).alias("u")
    each = usable.groupBy(*keys, "StartDate", *attrs).agg(F.count(F.lit(1)).alias("_m")).alias("e")
    wins = F.col("_best").eqNullSafe(F.struct(F.lit(1).alias("_one"), *[F.col(f"e.{c}") for c in attrs]))
    same_day = each.join(used, _same("e", "u", keys) & (F.col("e.StartDate") == F.col("u.StartDate"))).select(
        *[F.col(f"e.{c}") for c in ch.columns],
        F.explode(F.array_repeat(F.lit("same day"), (F.col("_m") - wins.cast("int")).cast("int"))).alias("reason"))
    return out, chk.where("reason is not null").select(*ch.columns, "reason").unionByName(same_day)


def _ordered(versions: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """The timeline of keys with few versions: both neighbours come from windows per key, after one shuffle."""
    line = Window.partitionBy(*keys).orderBy("StartDate", "_is_new", *tracked)
    same = F.lag(F.lit(True)).over(line).isNotNull()
    for c in tracked:
        same = same & F.lag(c).over(line).eqNullSafe(F.col(c))
    kept = versions.withColumn("_same", same).where(~((F.col("_is_new") == 1) & F.col("_same"))).drop("_same")
    return (kept.withColumn("_next", F.lead("StartDate").over(line))
            .withColumn("EndDate", F.coalesce(F.date_sub(F.col("_next"), 1), F.lit(OPEN_END).cast("date")))
            .withColumn("IsCurrent", F.col("_next").isNull()).drop("_next"))


def _timeline(versions: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Drop changes equal to the version before them, then end each version
    the day before the next one starts.

    Neighbours are found by numbering each key's versions (skew-safe
    ``row_number_within``) and joining on (key, number ± 1): an equi-join
    whose rows spread over tasks even when one key has most of the batch.
    """
    order = [("StartDate", "asc"), ("_is_new", "asc")] + [(c, "asc") for c in tracked]
    v = row_number_within(versions, keys, order, out="_rn")
    prev = v.select(*keys, (F.col("_rn") + 1).alias("_rn"), F.lit(True).alias("_has_prev"),
                    *[F.col(c).alias(f"_p_{c}") for c in tracked])
    v = v.join(prev, keys + ["_rn"], "left")
    same = F.coalesce(F.col("_has_prev"), F.lit(False))
    for c in tracked:
        same = same & F.col(f"_p_{c}").eqNullSafe(F.col(c))
    kept = v.where(~((F.col("_is_new") == 1) & same)).drop("_rn", "_has_prev", *[f"_p_{c}" for c in tracked])
    k = row_number_within(kept, keys, order, out="_rn")
    nxt = k.select(*keys, (F.col("_rn") - 1).alias("_rn"), F.col("StartDate").alias("_next"))
    return (k.join(nxt, keys + ["_rn"], "left")
            .withColumn("EndDate", F.coalesce(F.date_sub(F.col("_next"), 1), F.lit(OPEN_END).cast("date")))
            .withColumn("IsCurrent", F.col("_next").isNull()).drop("_next", "_rn"))


# M3
def scd3_apply(target: DataFrame, changes: DataFrame, keys: Sequence[str], source_col: str,
               effective_col: str, current_col: str = "Current", previous_col: str = "Previous",
               date_col: str = "LastUpdatedDate") -> DataFrame:
    """SCD-3: on a changed value, current moves to previous and the new value
    becomes current; unseen keys are inserted with no previous value.

    Several changes for one key fail the job. A NULL key matches a NULL key.
    """
    keys = list(keys)
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = one_per_key(changes, keys).withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, _same("t", "s", keys), "full_outer")
    has_t, has_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    changed = has_t & has_s & ~F.col(f"t.{current_col}").eqNullSafe(F.col(f"s.{source_col}"))
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c == current_col:
            out.append(F.when(~has_t | changed, F.col(f"s.{source_col}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif c == previous_col:
            out.append(F.when(changed, F.col(f"t.{current_col}")).when(~has_t, F.lit(None))
                       .otherwise(F.col(f"t.{c}")).alias(c))
        elif c == date_col:
            out.append(F.when(~has_t | changed, F.col(f"s.{effective_col}").cast("date"))
                       .otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(has_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


# M5
def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                     order: Sequence[str] | None = None) -> DataFrame:
    """``INSERT .. ON CONFLICT DO NOTHING``: rows whose key is new (one per key) are appended."""
    keys = list(keys)
    rows = rows.select(*target.columns)
    first = latest_per_key(rows, keys, list(order or [c for c in rows.columns if c not in keys]),
                           ascending=True)
    new = first.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


# M10
def _digests(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Per bucket of keys: rows and an order-independent digest of all columns."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    # two independent sums: rows that differ agree in both with probability 2**-128
    two = [F.sum(F.xxhash64(F.lit(i), row).cast("decimal(38,0)")).alias(f"_s{i}") for i in (1, 2)]
    return rows.groupBy(_bucket(key, buckets).alias("_b")).agg(F.count(F.lit(1)).alias("_n"), *two)


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(buckets)).cast("int")


def snapshot_pairs(old: DataFrame, new: DataFrame, key: Sequence[str], buckets: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Compare two snapshots by buckets of keys: ``(pairs, counts)``.

    ``counts`` has one row: ``n_old, n_new, n_equal``, the last being the rows
    in buckets whose digests agree; such buckets are equal row by row and are
    not joined. ``pairs`` joins the rows of all other buckets (``o``, ``n``:
    structs of the columns, null where a side has no such key; a NULL key
    matches a NULL key). Both snapshots are combined map-side to one row a
    bucket; only rows of changed buckets are shuffled.
    """
    key = list(key)
    spark = old.sparkSession
    sides = _digests(old, key, buckets).withColumn("_old", F.lit(True)).unionByName(
        _digests(new, key, buckets).withColumn("_old", F.lit(False)))
    sums: dict[int, dict[bool, tuple]] = {}
    for r in sides.collect():  # at most one row a bucket and side
        sums.setdefault(r["_b"], {})[r["_old"]] = (r["_n"], r["_s1"], r["_s2"])
    n_old, n_new = (sum(s[side][0] for s in sums.values() if side in s) for side in (True, False))
    differ = [b for b, s in sums.items() if s.get(True) != s.get(False)]
    counts = spark.createDataFrame([(n_old, n_new, n_old - sum(sums[b][True][0] for b in differ if True in sums[b]))],
                                   "n_old bigint, n_new bigint, n_equal bigint")
    keep = F.broadcast(spark.createDataFrame([(b,) for b in differ], "_b int"))

    def changed(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("_b", _bucket(key, buckets)).join(keep, "_b", "left_semi").select(
            *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(key)], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))

    o, n = changed(old, "o").alias("l"), changed(new, "n").alias("r")
    return o.join(n, _same("l", "r", [f"k{i}" for i in range(len(key))]), "full_outer").select("o", "n"), counts


def change_counts(old: DataFrame, new: DataFrame, sk_col: str = "SK") -> DataFrame:
    """Rows inserted, closed and unchanged between two SCD-2 snapshots (one row)."""
    cols = [F.col(sk_col).alias("_sk"), F.col("IsCurrent").alias("_c")]
    pairs, counts = snapshot_pairs(old.select(*cols), new.select(*cols), ["_sk"])
    c = lambda p: F.count(F.when(p, 1))
    found = pairs.agg(c(F.col("o").isNull()).alias("ins"), c(F.col("o._c") & ~F.col("n._c")).alias("closed"),
                      c(F.col("o").isNotNull() & F.col("n").isNotNull() & F.col("o._c").eqNullSafe(F.col("n._c"))).alias("same"))
    found = counts.withColumn("f", found.select(F.struct("*")).scalar())
    return found.select("n_old", "n_new", F.col("f.ins").alias("n_inserted"), F.col("f.closed").alias("n_closed"),
                        (F.col("f.same") + F.col("n_equal")).alias("n_unchanged"))


def affected_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows inserted, updated, deleted and unchanged between two snapshots with one row per key (one row)."""
    pairs, counts = snapshot_pairs(old, new.select(*old.columns), keys)
    c = lambda p: F.count(F.when(p, 1))
    has_o, has_n, same = F.col("o").isNotNull(), F.col("n").isNotNull(), F.col("o").eqNullSafe(F.col("n"))
    found = pairs.agg(c(~has_o).alias("ins"), c(has_o & has_n & ~same).alias("upd"), c(~has_n).alias("del"), c(has_o & same).alias("same"))
    found = counts.withColumn("f", found.select(F.struct("*")).scalar())
    return found.select(F.col("f.ins").alias("n_inserted"), F.col("f.upd").alias("n_updated"), F.col("f.del").alias("n_deleted"),
                        (F.col("f.same") + F.col("n_equal")).alias("n_unchanged"))
