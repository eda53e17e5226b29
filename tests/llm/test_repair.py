import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from lakemart.llm import queries as Q
from lakemart.llm import repair as R

SF = "/root/testdata/sf0.01"
FINE = re.compile(r"(s?(ua)+)?")
NON_SPACE = re.compile("[^\x20\x09-\x0d]")


def damaged(rows):
    """The contract's damage, row by row."""
    out = []
    for conv, turn, role, text in rows:
        act = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if act == 0:
            continue
        text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
        out += [(conv, turn, "user" if act == 4 else role, text)] * (2 if act == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        shown = NON_SPACE.findall(text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else
                   "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best(rows, fault):
    """Cheapest edits by uniform-cost search over (cost, edits so far): the first goal popped is the ASCII-least."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit
        turn = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, turn))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if fault[i] not in ("blank", "duplicate"):
                more = fault[i] == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, turn))
                role = rows[i][2][:1]
                if role and role == turn or role == "s" and last == "":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role))


def expected(rows, conv, tie=lambda r: (r[2], hashlib.sha256(r[3].encode()).hexdigest())):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, *tie(r)))
    fault = faults(rows)
    cost, audit = best(rows, fault)
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    out, left, last = [], iter(rows), ""
    for e in audit:
        role, text = ("assistant" if last == "u" else "user"), ""
        if e != "I":
            r = next(left)
            if e == "D":
                continue
            role, text = (r[2] if e == "K" else role), r[3]
        out.append(f"{role}:{text}")
        last = role[0]
    assert FINE.fullmatch("".join(x[0] for x in out))
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, `a.b` string, h string"


def check(got, rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], [])
    for r in damaged(rows):
        groups[r[0]].append(r)
    want = {expected(v, k) for k, v in groups.items()}
    have = [tuple(r[c] for c in COLS) for r in got.collect()]
    assert len(have) == len(groups)
    assert set(have) == want


def test_whole_table_against_uniform_cost_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(Q.op12_conversation_repair(spark, SF).select(COLS), rows)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "a", "h") for r in rows], SCHEMA)


def run(spark, rows):
    return R.with_digest(R.repair(frame(spark, rows), damaged=True)).withColumnRenamed("conv", "conv_id")


def test_odd_rows(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", None, "", "tool", "User", "summary"]
    texts = [None, "", " \n", "Fine.", "Fine.", "Well", "a?\n", "long " * 40_000 + ".", "é!", "x. "]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts)) for _ in range(250)]
    rows += rows[:40]  # repeated rows
    rows += [(8, t, "user", "Same.") for t in range(200)]  # one conversation of copies
    rows += [(c, None, None, None) for c in range(100, 130)]  # some of these lose their only row
    check(run(spark, rows), rows)


def test_long_conversation_and_many_partitions(spark):
    rng = random.Random(6)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", "No", f"Turn {t}.", f"turn {t}", ""])) for t in range(3000)]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        check(run(spark, rows), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_empty_table(spark):
    out = run(spark, [(1, 1, "user", "x")]).limit(0)
    assert out.columns == COLS
    assert run_empty(spark).count() == 0


def run_empty(spark):
    return R.with_digest(R.repair(frame(spark, [(1, 1, "user", "x")]).where("conv_id < 0"), damaged=True))


def test_repaired_rows_without_damage(spark):
    rows = [(1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Why"), (2, 1, "user", "Hi."), (2, 2, "assistant", "Ho.")]
    fixed = R.repair(frame(spark, rows))
    got = sorted((r["conv"], r["position"], r["role"], r["text"]) for r in fixed.rows.collect())
    audits = {r["conv"]: (r["cost"], r["audit"]) for r in fixed.edits.collect()}
    # insert a question first, drop the copy, and answer the last question, or reuse rows: the search decides
    assert audits[2] == (0, "KK")
    assert [g[1:] for g in got if g[0] == 2] == [(1, "user", "Hi."), (2, "assistant", "Ho.")]
    assert audits[1][0] == best([(1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "user", "Why")], ["", "duplicate", "truncated"])[0]


@pytest.mark.parametrize("block", [1, 2, 3, 16])
def test_blocks_agree_with_uniform_cost_search(block):
    rng = random.Random(block)
    names = {"s": "system", "u": "user", "a": "assistant", "?": "x"}
    kinds = ["", "truncated", "duplicate", "blank"]
    some = [[(r, f) for r in "sua?" for f in range(4)] for _ in range(1)][0]
    short = [list(p) for n in range(3) for p in itertools.product(some, repeat=n)]
    long = [[rng.choice(some) for _ in range(rng.randrange(3, 40))] for _ in range(300)]
    for case in short + long:
        symbols = "".join(R.SYMBOLS[4 * f + "sua?".index(r)] for r, f in case)
        rows = [(0, 0, names[r], "") for r, _ in case]
        assert R.cheapest(symbols, block) == best(rows, [kinds[f] for _, f in case])
