"""Misspelt category values found through an index of deletions.

Two values within ``max_edits`` edits of each other become equal after at
most that many characters are deleted from each. So every allowed value and
every distinct raw value is listed under the digests of its deletions, an
equi-join brings both together, and the edit distance of the pairs decides.
Nothing is compared with all allowed values, and rows are only touched by the
last join, on their value.

Values are compared trimmed and in upper case. An edit inserts, deletes or
replaces one character; two neighbours swapped, and nothing else, count as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions.columns import scalar_lit

EXACT, REPAIRED, AMBIGUOUS, UNKNOWN, MISSING = "exact", "repaired", "ambiguous", "unknown", "missing"


def _folded(c: Column) -> Column:
    return F.upper(F.trim(c))


def _one_less(c: Column) -> Column:
    """The texts that ``c`` becomes by deleting one character; none for an empty text."""
    at = F.when(F.length(c) > 0, F.sequence(F.lit(1), F.length(c))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1)))


def _deletions(c: Column, edits: int) -> Column:
    """Digests of ``c`` and of all texts with up to ``edits`` characters deleted, each once."""
    found = level = F.array(c)
    for _ in range(edits):
        level = F.array_distinct(F.flatten(F.transform(level, _one_less)))
        found = F.concat(found, level)
    return F.array_distinct(F.transform(found, lambda t: F.xxhash64(t)))


def edit_count(a: Column, b: Column) -> Column:
    """Levenshtein distance; 1 where swapping two neighbours of ``a`` gives ``b``."""
    n = F.levenshtein(a, b)
    swapped = F.exists(F.sequence(F.lit(1), F.length(a) - 1), lambda i: F.concat(
        F.substr(a, F.lit(1), i - 1), F.substr(a, i + 1, F.lit(1)), F.substr(a, i, F.lit(1)), F.substr(a, i + 2)) == b)
    return F.when((n == 2) & (F.length(a) == F.length(b)), F.when(swapped, 1).otherwise(2)).otherwise(n)


def typo_matches(values: DataFrame, allowed: DataFrame, max_edits: int = 1) -> DataFrame:
    """Decide on distinct values.

    ``values`` holds a column ``value`` (distinct, any spelling), ``allowed`` a
    column ``value``. Returns value, status, fixed, n_edits and candidates:

    * ``exact``: an allowed value but for case and blanks; ``fixed`` is that value;
    * ``repaired``: one allowed value is nearer than all others, within ``max_edits``;
    * ``ambiguous``: several are equally near; ``fixed`` is null and ``candidates`` lists them, sorted, joined by ``|``;
    * ``unknown``: none within ``max_edits``; ``missing``: null or blank.

    Allowed values that are null or blank are left out, and of those equal but
    for case and blanks the least is taken. The longest allowed value bounds
    the texts that are indexed: longer raw values (by more than ``max_edits``) can match nothing.
    """
    known = (allowed.select(F.col("value").alias("_to"), _folded(F.col("value")).alias("_t")).where(F.col("_t") != "")
             .groupBy("_t").agg(F.min("_to").alias("_to")))
    longest = scalar_lit(known.select(F.coalesce(F.max(F.length("_t")), F.lit(0))))
    raw = values.select("value", _folded(F.col("value")).alias("_f"))
    asked = raw.where((F.col("_f") != "") & (F.length("_f") <= longest + max_edits)).select("_f").distinct()
    pairs = (asked.select("_f", F.explode(_deletions(F.col("_f"), max_edits)).alias("_k"))
             .join(known.select("_t", "_to", F.explode(_deletions(F.col("_t"), max_edits)).alias("_k")), "_k")
             .select("_f", "_t", "_to").distinct()
             .withColumn("_n", edit_count(F.col("_f"), F.col("_t"))).where(F.col("_n") <= max_edits))
    # the nearest allowed values of a text: combined map-side, at most the allowed values within max_edits
    near = pairs.groupBy("_f", "_n").agg(F.sort_array(F.collect_set("_to")).alias("_all")) \
        .groupBy("_f").agg(F.min(F.struct("_n", "_all")).alias("_m"))
    n, found = F.col("_m._n"), F.col("_m._all")
    missing = F.coalesce(F.col("_f") == "", F.lit(True))
    status = (F.when(missing, MISSING).when(n.isNull(), UNKNOWN).when(n == 0, EXACT)
              .when(F.size(found) == 1, REPAIRED).otherwise(AMBIGUOUS))
    return raw.join(near, "_f", "left").select(
        "value", status.alias("status"), F.when(F.size(found) == 1, F.element_at(found, 1)).alias("fixed"),
        n.alias("n_edits"), F.when(F.size(found) > 1, F.array_join(found, "|")).alias("candidates"))


def typo_report(df: DataFrame, col: str, allowed: DataFrame, max_edits: int = 1) -> DataFrame:
    """One row per distinct value of ``col``: value, n_rows and what ``typo_matches`` says of it."""
    counted = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    found = typo_matches(counted.select("value"), allowed, max_edits)
    return counted.alias("c").join(found.alias("f"), F.col("c.value").eqNullSafe(F.col("f.value"))).select(
        "c.value", "n_rows", "status", "fixed", "n_edits", "candidates")


def repair_values(df: DataFrame, col: str, allowed: DataFrame, max_edits: int = 1, out: str | None = None,
                  status: str = "status") -> DataFrame:
    """``df`` with ``out`` (default: ``col`` itself) repaired and a ``status`` column.

    Values that are ambiguous, unknown or missing stay as they are. Only the
    distinct values that need a change travel to the rows: a small table that
    the join broadcasts once it is measured; beyond that it is an equi-join on
    the value, whose hot values are split as skew.
    """
    values = df.select(F.col(col).alias("value")).distinct()
    found = typo_matches(values, allowed, max_edits).select(
        F.col("value").alias("_v"), F.col("status").alias("_s"), F.coalesce("fixed", "value").alias("_to"))
    target = out or col
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (target, status)]
    same = F.col(f"`{col}`") == F.col("_v")
    return df.join(found.where(F.col("_v").isNotNull()), same, "left").select(
        *keep, F.col("_to").alias(target), F.coalesce("_s", F.lit(MISSING)).alias(status))
