"""Repair of conversations by iterative-deepening A* over edit sequences.

A conversation is well formed if its roles are nothing, or an optional system
turn followed by user and assistant turns in alternation, ending with the
assistant. Edits are keep, rerole, delete and insert; the cheapest sequence
that gives a well-formed conversation wins, ties going to the sequence that
comes first in ASCII order of the edits' initials (D, I, K, R).

Only a symbol per row (initial of the role and fault) is gathered for a whole
conversation. The search runs over blocks of rows from every possible state
to every possible state, so its cost is in proportion to the rows, and the
blocks are joined by the cheapest chain of states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.store import written
from lakemart.session import shuffle_partitions

# fixed values: costs of the edits and of a truncated row that stays
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
# a row's symbol: 4 * fault + role; faults none, truncated, duplicate, blank; roles system, user, assistant, other
ROLES, FAULTS = "sua", ("none", "truncated", "duplicate", "blank")
SYMBOLS = "abcdefghijklmnop"
# states: nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
END = -1
FOLLOWS = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
NEXT = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LAWFUL = {"su", "ua", "au"}
BLOCK = 16
NEVER = 1 << 60


def _role(symbol: str) -> str:
    return (ROLES + "?")[SYMBOLS.index(symbol) % 4]


def _fault(symbol: str) -> int:
    return SYMBOLS.index(symbol) // 4


@lru_cache(maxsize=200_000)
def search(rows: str, entry: int, goal: int) -> tuple[int, str] | None:
    """Cheapest edits of ``rows`` that lead from state ``entry`` to ``goal``: (cost, initials), or None.

    ``goal`` END accepts any well-formed end and may insert after the last
    row; otherwise every insert comes before a row. Depth-first in ASCII order
    of the edits under a bound that grows by one; the bound prunes with what
    the remaining rows cost at least. ``failed`` holds, for every position and
    state, the largest remaining budget that led to nothing.
    """
    n = len(rows)
    must = [_fault(x) >= 2 for x in rows]
    extra = [TRUNCATED * (_fault(x) == 1) for x in rows]
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (DELETE if must[i] else extra[i])
    failed: dict[tuple[int, int], int] = {}

    def found(i: int, state: int, budget: int) -> str | None:
        if budget < rest[i] or failed.get((i, state), -1) >= budget:
            return None
        if i == n and (state == goal or goal == END and state in (START, ASSISTANT)):
            return ""
        if i < n:
            tail = found(i + 1, state, budget - DELETE)
            if tail is not None:
                return "D" + tail
        if i < n or goal == END:
            tail = found(i, USER if state != USER else ASSISTANT, budget - INSERT)
            if tail is not None:
                return "I" + tail
        if i < n and not must[i]:
            role = _role(rows[i])
            if role in FOLLOWS[state]:
                tail = found(i + 1, NEXT[role], budget - extra[i])
                if tail is not None:
                    return "K" + tail
            tail = found(i + 1, USER if state != USER else ASSISTANT, budget - REROLE - extra[i])
            if tail is not None:
                return "R" + tail
        failed[i, state] = budget
        return None

    # deleting all rows and inserting a pair reaches every state that can be reached at all
    for bound in range(rest[0], DELETE * n + 2 * INSERT + 1):
        audit = found(0, entry, bound)
        if audit is not None:
            return bound, audit
    return None


def cheapest(rows: str, block: int = BLOCK) -> tuple[int, str]:
    """Cost and edits of the best repair of a whole conversation given as symbols."""
    parts = [rows[i:i + block] for i in range(0, len(rows), block)] or [""]
    # cost from each state at the front of a part to the end
    after = [[(search(parts[-1], s, END) or (NEVER, ""))[0] for s in range(4)]]
    for part in reversed(parts[:-1]):
        costs = []
        for s in range(4):
            ways = [(search(part, s, g), after[-1][g]) for g in range(4)]
            costs.append(min((w[0] + c for w, c in ways if w), default=NEVER))
        after.append(costs)
    after.reverse()
    state, audit = START, []
    for k, part in enumerate(parts[:-1]):
        # different goals have different edits, none the front of another, so the first in order is right
        ways = [(w[0] + after[k + 1][g], w[1], g) for g in range(4) if (w := search(part, state, g))]
        _, edits, state = min(ways)
        audit.append(edits)
    audit.append(search(parts[-1], state, END)[1])
    return after[0][START], "".join(audit)


def illegal_pairs(rows: str) -> int:
    """Adjacent rows whose roles do not follow each other."""
    roles = [_role(x) for x in rows]
    return sum(a + b not in LAWFUL for a, b in zip(roles, roles[1:]))


# --- Spark


@dataclass(frozen=True)
class Columns:
    """Names of the conversation, turn, role and text columns."""

    conv: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    text: str = "text"


def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damage(conversations: DataFrame, names: Columns = Columns()) -> DataFrame:
    """``conv, turn, role, text, copies``: the rows after a repeatable damage; nulls of role and text are one space.

    crc32 of ``conv:turn`` (a null is one space) modulo 20 chooses: 0 drops the row, 1 empties the
    text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it (copies = 2), 4
    makes the role ``user``.
    """
    src = conversations.select(*[F.col(f"`{c}`").alias(k) for k, c in vars(names).items()])
    act = F.crc32(F.concat(_or_space(F.col("conv")), F.lit(":"), _or_space(F.col("turn"))).cast("binary")) % 20
    text, role = _or_space(F.col("text")), _or_space(F.col("role"))
    out = src.withColumn("act", act).where("act <> 0")
    return out.select("conv", "turn", F.when(F.col("act") == 4, F.lit("user")).otherwise(role).alias("role"),
                      F.when(F.col("act") == 1, F.lit("")).when(F.col("act") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                      F.when(F.col("act") == 3, F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, h, copies, first, fault, later``: one narrow row per distinct (conv, turn, role, text).

    ``fault`` is that of the first of its copies, ``later`` that of the
    others. ``h`` is the text's SHA-256; texts themselves are not shuffled.
    Rows are counted before the shuffle, so a mass of copies is one row a task.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    end = F.when(bare == "", F.lit(3)).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), F.lit(0)).otherwise(F.lit(1))
    narrow = rows.select("conv", "turn", "role", F.sha2("text", 256).alias("h"), end.alias("end"), "copies")
    each = narrow.groupBy("conv", "turn", "role", "h").agg(F.first("end").alias("end"), F.sum("copies").alias("copies"))
    # the first turn of a role and text; structs order nulls first
    first = each.groupBy("conv", "role", "h").agg(F.min(F.struct("turn")).alias("m")).select("conv", "role", "h", F.col("m.turn").alias("first"))
    a, b = each.alias("a"), first.alias("b")
    same = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.h") == F.col("b.h"))
    new = F.col("b.first").eqNullSafe(F.col("a.turn"))
    blank = F.col("a.end") == 3
    return a.join(b, same).select("a.conv", "a.turn", "a.role", "a.h", "a.copies",
                                  F.when(new | blank, F.col("a.end")).otherwise(F.lit(2)).alias("fault"),
                                  F.when(blank, F.lit(3)).otherwise(F.lit(2)).alias("later"))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols of the runs of equal conversations inside a sorted partition."""
    at = TaskContext.get().partitionId()
    conv, parts, number, schema = None, [], 0, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([conv], type=schema), pa.array([at], pa.int32()),
                                           pa.array([number], pa.int32()), pa.array(["".join(parts)])],
                                          names=["conv", "part", "number", "symbols"])

    for batch in batches:
        schema = batch.column(0).type
        for c, role, copies, fault, later in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if parts and c != conv:
                yield row()
                number, parts = number + 1, []
            conv = c
            which = (ROLES.find(role[0]) if role else -1) % 4
            parts.append(SYMBOLS[4 * fault + which] + SYMBOLS[4 * later + which] * (copies - 1))
    if parts:
        yield row()


def structure(rows: DataFrame) -> DataFrame:
    """``conv, symbols``: a symbol for each row of every conversation, in order.

    Rows are dealt out by ranges of (conversation, turn, role, text digest),
    so a conversation with most of all rows is read by many tasks; only its
    symbols, one character a row, meet in one row.
    """
    key = ["conv", F.col("turn").asc_nulls_first(), "role", "h"]
    seg = (rows.repartitionByRange(*key).sortWithinPartitions(*key).select("conv", "role", "copies", "fault", "later")
           .mapInArrow(_segments, f"conv {rows.schema['conv'].dataType.simpleString()}, part int, number int, symbols string"))
    joined = F.array_sort(F.collect_list(F.struct("part", "number", "symbols")))
    # symbols are few bytes and long work: a fixed number of partitions, which is not merged by size
    return seg.repartition(shuffle_partitions(rows.sparkSession), "conv").groupBy("conv").agg(F.array_join(F.transform(joined, lambda x: x["symbols"]), "").alias("symbols"))


FOUND = ("blank", "duplicate", "truncated", "illegal", "cost")


@F.arrow_udf(T.StructType([T.StructField(k, T.LongType()) for k in FOUND] + [T.StructField("audit", T.StringType())]))
def repaired(symbols: pa.Array) -> pa.Array:
    out = []
    for s in symbols.to_pylist():
        cost, audit = cheapest(s)
        count = [sum(s.count(SYMBOLS[4 * f + r]) for r in range(4)) for f in range(4)]
        out.append({"blank": count[3], "duplicate": count[2], "truncated": count[1], "illegal": illegal_pairs(s),
                    "cost": cost, "audit": audit})
    return pa.array(out, type=pa.struct([(k, pa.int64()) for k in FOUND] + [("audit", pa.string())]))


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams a sorted partition: each conversation's edits, then its rows; gives the repaired rows in order."""
    conv = audit = schema = None
    at, last, n = 0, "", 0
    out: list[tuple] = []

    def put(role: str, text: str) -> None:
        nonlocal last, n
        n += 1
        out.append((conv, n, role, text))
        last = role[0]

    def turn() -> str:
        return "assistant" if last == "u" else "user"

    def inserts() -> None:
        nonlocal at
        while audit is not None and at < len(audit) and audit[at] == "I":
            put(turn(), "")
            at += 1

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [[]] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], schema), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                                           pa.array(cols[3], pa.string())], names=["conv", "position", "role", "text"])

    for batch in batches:
        schema = batch.column(0).type
        for c, edits, role, text, copies in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if edits is not None:
                inserts()
                conv, audit, at, last, n = c, edits, 0, "", 0
                continue
            for _ in range(copies):
                inserts()
                if audit[at] != "D":
                    put(role if audit[at] == "K" else turn(), text)
                at += 1
        yield flush()
    inserts()
    if out:
        yield flush()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines; its rows follow one another."""
    digest, conv, schema = None, None, None
    ids, out = [], []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(ids, schema), pa.array(out, pa.string())], names=["conv", "sha"])
        ids.clear(), out.clear()
        return batch

    for batch in batches:
        schema = batch.column(0).type
        for c, n, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if n == 1:
                if digest is not None:
                    ids.append(conv), out.append(digest.hexdigest())
                digest, conv = hashlib.sha256(), c
            digest.update((("\n" if n > 1 else "") + role + ":" + text).encode())
        yield flush()
    if digest is not None:
        ids.append(conv), out.append(digest.hexdigest())
        yield flush()


@dataclass(frozen=True)
class Repair:
    """``edits``: one row per conversation; ``rows``: the repaired rows, each partition in order of conversation and position."""

    edits: DataFrame
    rows: DataFrame


def _null_safe(a: str, b: str) -> Column:
    return F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv"))


def repair(conversations: DataFrame, names: Columns = Columns(), damaged: bool = False) -> Repair:
    """Faults, cheapest edits and repaired rows of every conversation.

    ``edits``: ``conv, gaps, blank, duplicate, truncated, illegal, cost,
    audit``; ``rows``: ``conv, position, role, text``. ``damaged`` first
    damages the rows (``damage``). Rows are taken by turn, nulls first, ties
    by role, then SHA-256 of the text; nulls of role and text are one space.
    A row's fault is the first that fits: blank, duplicate (role and text seen
    earlier), truncated. A role counts by its first character; an empty role
    fits nowhere. ``audit`` holds the initials of the edits. A null id is a
    conversation of its own; one whose rows are all dropped has zeros and no
    edits. Rows that repeat are duplicates. An empty table gives no row; other
    columns are ignored.

    The repaired rows come from one sorted stream a conversation, in which one
    row is held at a time; a very long text is one row.
    """
    src = conversations.select(*[F.col(f"`{c}`").alias(k) for k, c in vars(names).items()])
    if damaged:
        rows = damage(conversations, names)
    else:
        rows = src.select("conv", "turn", _or_space(F.col("role")).alias("role"), _or_space(F.col("text")).alias("text"),
                          F.lit(1).cast("bigint").alias("copies"))
    gaps = rows.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    marks = structure(faults(rows)).select("conv", repaired("symbols").alias("r")).select("conv", "r.*")
    ids = src.select("conv").distinct()
    stats = ids.alias("i").join(marks.alias("m"), _null_safe("i", "m"), "left").join(gaps.alias("g"), _null_safe("i", "g"), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *FOUND)]
    stats = written(stats.select("i.conv", *zero, F.coalesce("audit", F.lit("")).alias("audit")), "conversation_edits")

    none = F.lit(None).cast("string")
    feed = stats.select("conv", "audit", none.alias("role"), none.alias("text"), F.lit(0).cast("bigint").alias("copies"),
                        F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), none.alias("h")).unionByName(
        rows.withColumn("audit", none).withColumn("h", F.sha2("text", 256)))
    order = ["conv", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", "h"]
    schema = T.StructType([T.StructField("conv", rows.schema["conv"].dataType), T.StructField("position", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    fixed = (feed.repartition("conv").sortWithinPartitions(*order).select("conv", "audit", "role", "text", "copies")
             .mapInArrow(_edit, schema))
    return Repair(stats, fixed)


def with_digest(fixed: Repair) -> DataFrame:
    """``edits`` with ``repaired_sha256``, the SHA-256 of the repaired ``role:text`` lines joined by newlines."""
    schema = T.StructType([T.StructField("conv", fixed.edits.schema["conv"].dataType), T.StructField("sha", T.StringType())])
    digests = fixed.rows.mapInArrow(_digests, schema)
    return fixed.edits.alias("s").join(digests.alias("d"), _null_safe("s", "d"), "left").select(
        "s.*", F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
