"""Mixing sources to target weights under a token budget.

The budget flows down a tree (say domain, language, source): at each node it
is shared among the children by weight. A child that has fewer tokens than
its share gives the rest to its siblings, by weight again; only what the
whole family lacks goes to the parent's siblings. Each leaf then takes the
first tokens of its documents in a seeded order, epoch after epoch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.store import free_name, written

_MISSING = "(none)"
MAX_BROADCAST_LEAVES = 100_000  # of about 100 bytes


@dataclass(frozen=True)
class Mix:
    """Parameters.

    ``levels``: one column of the input per tree level, root first.
    ``weights``: whole numbers per level and value; a value without one
    weighs 1, and what weighs 0 is not used. The budget is ``budget`` tokens or, if that is None,
    ``percent`` of all tokens (rounded down). A document is used at most
    ``max_epochs`` times.
    """

    levels: tuple[str, ...]
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    budget: int | None = None
    percent: int = 60
    max_epochs: int = 2
    seed: int = 17


def token_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def order_key(seed: int, epoch: Column, id_text: Column) -> Column:
    """60 bits that put the documents of an epoch in order."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), id_text)), 1, 15),
                  16, 10).cast("bigint")


def _weight(level: str, name: str, p: Mix) -> Column:
    given = p.weights.get(level, {})
    if not given:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for kv in given.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.col(name)), F.lit(1))


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _share(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Column ``alloc``: each child's part of its parent's ``given``, capped by its ``cap``.

    Children sorted by tokens per weight: the first ones are full as long as
    they hold no more than an even share by weight of what is then left.
    All comparisons are in whole numbers.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    line = group.orderBy((F.col("cap") / F.when(F.col("weight") > 0, F.col("weight"))).asc_nulls_last(), child)
    before = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    n = nodes.withColumn("before", before).withColumn("after", after).withColumn(
        "full", _wide(F.col("cap")) * _wide(F.col("after")) <= _wide(F.col("given") - F.col("before")) * _wide(F.col("weight")))
    n = n.withColumn("used", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0))).withColumn(
        "open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(group))
    rest = F.expr("cast(given - used as decimal(19,0)) * cast(weight as decimal(19,0)) div nullif(open, 0)")
    return n.withColumn("alloc", F.when(F.col("full"), F.col("cap")).otherwise(F.coalesce(rest, F.lit(0))))


def leaf_budgets(leaves: DataFrame, names: list[str], p: Mix) -> DataFrame:
    """``leaves(*names, tokens)`` with ``alloc``, the tokens that each leaf gives."""
    used = F.lit(True)
    for level, name in zip(p.levels, names):
        used = used & (_weight(level, name, p) > 0)
    cap = F.when(used, F.col("tokens") * p.max_epochs).otherwise(0)
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("given"))
    given = total.select(F.lit(p.budget).cast("bigint").alias("given")) if p.budget is not None else total.select(
        F.expr(f"given * {p.percent} div 100").alias("given"))
    above = None
    for depth, level in enumerate(p.levels):
        keys = names[:depth + 1]
        nodes = leaves.groupBy(*keys).agg(F.sum(cap).cast("bigint").alias("cap")).withColumn(
            "weight", _weight(level, names[depth], p).cast("bigint"))
        if above is None:
            nodes = nodes.withColumn("given", given.scalar())
        else:
            nodes = nodes.join(above, names[:depth])
        above = _share(nodes, names[:depth], names[depth]).select(*keys, F.col("alloc").cast("bigint").alias("given"))
    return leaves.join(above.withColumnRenamed("given", "alloc"), names)


def select(docs: DataFrame, p: Mix, id_col: str = "doc_id", text_col: str = "text", to: str = "copies",
           to_tokens: str = "tokens") -> DataFrame:
    """The documents used, with ``to_tokens`` and the number of times each is used.

    A leaf that gives ``a`` of its ``t`` tokens uses every document ``a div
    t`` times and, in the order of the next epoch's seed, the longest run of
    first documents that fits in the rest (if any); it never exceeds its budget. A
    null level value is a value of its own; null and empty texts have no
    tokens; null ids sort as the empty text. Rows with equal order (repeated
    ids) are used together or not at all. Extra columns pass unchanged; the
    two result columns replace columns of the same name.

    Plan: the tree is computed on one row per leaf. The cut of a leaf is
    found in a histogram over ranges of the order key, then in the one range
    that holds it, so no leaf's documents are ever sorted in one task.
    """
    names = [f"level_{i}" for i in range(len(p.levels))]
    id_text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    narrow = docs.select(
        id_text.alias("id"), token_count(F.col(f"`{text_col}`")).alias("tokens"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(_MISSING)).alias(n) for c, n in zip(p.levels, names)])
    narrow = written(narrow, "mix_rows")
    leaves = written(narrow.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "mix_leaves")
    size = leaves.agg(F.count("*").alias("n"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()

    def small(df):  # bounded by the measured number of leaves
        return F.broadcast(df) if size["n"] <= MAX_BROADCAST_LEAVES else df

    plan = leaf_budgets(leaves.drop("rows"), names, p).where("alloc > 0 and tokens > 0").select(
        *names, F.expr("alloc div tokens").alias("epochs"), F.expr("alloc % tokens").alias("rest"))
    plan = written(plan, "mix_plan")
    # ranges of the order key small enough that one holds about two thousand documents
    bits = min(30, max(4, math.ceil(math.log2(max(1, size["rows"]) / 2000)))) if size["rows"] else 4
    rows = narrow.join(small(plan), names).withColumn("key", order_key(p.seed, F.col("epochs"), F.col("id"))).withColumn(
        "range", F.shiftright("key", 60 - bits))
    ranges = rows.groupBy(*names, "rest", "range").agg(F.sum("tokens").alias("t"))
    upto = F.sum("t").over(Window.partitionBy(*names).orderBy("range"))
    cut = written(ranges.withColumn("upto", upto).where(F.col("upto") > F.col("rest")).groupBy(*names).agg(
        F.min(F.struct("range", (F.col("upto") - F.col("t")).alias("before"))).alias("c")
    ).select(*names, "c.*"), "mix_cuts")
    inside = rows.join(small(cut), [*names, "range"]).withColumn(
        "upto", F.col("before") + F.sum("tokens").over(Window.partitionBy(*names, "range").orderBy("key", "id")))
    last = inside.where(F.col("upto") <= F.col("rest")).groupBy(*names).agg(F.max(F.struct("key", "id")).alias("last"))
    bound = plan.join(cut, names).join(last, names, "left").select(
        *names, "epochs", F.when(F.col("rest") > 0, F.shiftleft(F.col("range"), 60 - bits)).otherwise(0).alias("start"),
        F.when(F.col("rest") > 0, F.col("last.key")).alias("last_key"), F.col("last.id").alias("last_id"))
    bound = written(bound, "mix_bounds")

    tmp = {n: free_name(docs, n) for n in [*names, "epochs", "start", "last_key", "last_id", "order_key", "order_id"]}
    out = docs.withColumn(to_tokens, token_count(F.col(f"`{text_col}`")))
    for c, n in zip(p.levels, names):
        out = out.withColumn(tmp[n], F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(_MISSING)))
    out = out.join(small(bound.select(*[F.col(c).alias(tmp[c]) for c in bound.columns])), [tmp[n] for n in names])
    out = out.withColumn(tmp["order_id"], id_text).withColumn(
        tmp["order_key"], order_key(p.seed, F.col(tmp["epochs"]), F.col(tmp["order_id"])))
    key, start = F.col(tmp["order_key"]), F.col(tmp["start"])
    upto_last = (key < F.col(tmp["last_key"])) | ((key == F.col(tmp["last_key"])) & (F.col(tmp["order_id"]) <= F.col(tmp["last_id"])))
    in_rest = (key < start) | F.coalesce(upto_last, F.lit(False))
    out = out.withColumn(to, (F.col(tmp["epochs"]) + F.when(in_rest, 1).otherwise(0)).cast("bigint"))
    return out.where(F.col(to) > 0).drop(*tmp.values())
