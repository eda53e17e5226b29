"""Sharding, licences, mixing and line runs: DuckDB on the tables, brute force on odd rows."""

import os

import duckdb
import pytest

from lakemart.llm import licenses, line_dedup, mixing, queries, shards, sql
from tests.llm.conftest import prose
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = queries.queries()[name](spark, SF)
    res = con.execute(queries.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_table_is_even_and_stable():
    names = [f"s{i}" for i in range(9)]
    t = shards.lookup_table(names, 1009)
    sizes = [t.count(i) for i in range(9)]
    assert max(sizes) - min(sizes) <= 1
    fewer = shards.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(t, fewer) if a != 8)
    assert moved < 0.3 * 1009
    for bad in (1000, 4, 1):
        with pytest.raises(ValueError):
            shards.lookup_table(names, bad)
    with pytest.raises(ValueError):
        shards.lookup_table(["a", "a"], 1009)
    assert shards.lookup_table(["only"], 2) == [0, 0]


def test_placing_odd_rows(odd_docs, no_docs):
    df = odd_docs.withColumnRenamed("n", "shard")
    out = shards.place(df, ["a", "b", "c"], 101, "doc_id")
    assert out.columns == [*df.columns, "slot", "shard_1"] and out.count() == df.count()
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, set()).add(r.shard_1)
    assert all(len(x) == 1 and x <= {"a", "b", "c"} for x in by.values())
    assert shards.place(no_docs, ["a"], 101, "doc_id").count() == 0


def test_licence_texts(make_docs, odd_docs, no_docs, spark):
    known = spark.createDataFrame(list(sql.LICENSES.items()) + [("empty", ""), (None, "x y z"), ("null", None)], "license string, text string")
    mit = sql.LICENSES["MIT"]
    changed = "COPYRIGHT 2021 Somebody, all rights\n" + mit.upper().replace("LICENSE", "LICENCE").replace(",", " ;").replace("\n\n", "\n\n© me\n* ")
    rows = make_docs([(50, mit), (51, changed), (52, mit.replace("person", "robot")), (53, mit + " more"),
                      (54, prose(1, 9) + "\nReleased under the MIT Licence\nlicensed under CC-BY NC 4.0!\n" + prose(2, 9))])
    got = {r.doc_id: (r.license, r.notices) for r in licenses.scan(rows.unionByName(odd_docs), known).collect()}
    assert got[50] == ("MIT", []) and got[51] == ("MIT", []) and got[52] == (None, []) and got[53] == (None, [])
    assert got[54] == (None, ["CC-BY-NC-4.0 notice", "MIT notice"])
    assert all(got[i] == (None, []) for i in (1, 2, 3, 4, 5, 6, 7, 9, 10))
    assert licenses.scan(no_docs, known).count() == 0
    assert licenses.scan(odd_docs, known.limit(0)).where("license is not null").count() == 0


def test_licences_by_digest(spark, make_docs):
    """A long text is known by its digest alone, however its lines are broken."""
    known = spark.createDataFrame(list(sql.LICENSES.items()), "license string, text string")
    text = "\n".join(prose(i, 12) for i in range(40))
    long = licenses.known_digests(spark.createDataFrame([("long", text)], "license string, text string"))
    docs = make_docs([(1, text.upper().replace("\n", " \n\n")), (2, text + " x"), (3, sql.LICENSES["BSD-3-Clause"].replace("\n   ", "\n\t* ")),
                      (4, sql.LICENSES["BSD-2-Clause"]), (5, "Copyright 2001 A\n\n" + sql.LICENSES["Zlib"]), (6, sql.LICENSES["Unlicense"])])
    got = {r.doc_id: r.license for r in licenses.scan(docs, known, digests=long).collect()}
    assert got == {1: "long", 2: None, 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: "Zlib", 6: "Unlicense"}
    assert all(len(d) == 64 for d in sql.LICENSE_DIGESTS.values())


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="no licence texts on this machine")
@pytest.mark.parametrize("name,file", [("Apache-2.0", "Apache-2.0"), ("CC0-1.0", "CC0-1.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"),
                                       ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0")])
def test_long_licences(spark, name, file):
    with open(f"/usr/share/common-licenses/{file}") as f:
        df = spark.createDataFrame([(name, f.read())], "license string, text string")
    assert licenses.known_digests(df).first().digest == sql.LICENSE_DIGESTS[name]


def test_many_lines(spark, make_docs):
    """A passage removed from, and runs kept in, texts of 20,000 lines."""
    own = [f"{prose(i % 97, 6)} {i}" for i in range(20_000)]
    later = [x if i % 4 else f"{x} changed" for i, x in enumerate(own)]
    later[500:512] = own[500:512]  # 12 lines of 7 words
    docs = make_docs([(1, "\n".join(own)), (2, "\n".join(later))])
    got = {r.doc_id: (r.text, r.removed) for r in line_dedup.dedup_lines(docs, to_removed="removed").collect()}
    low, high = 500, 511
    while later[low - 1] == own[low - 1]:
        low -= 1
    while later[high + 1] == own[high + 1]:
        high += 1
    gone = set(range(low, high + 1))
    assert got[1] == ("\n".join(own), 0)
    assert got[2] == ("\n".join(x for i, x in enumerate(later) if i not in gone), len(gone))
    assert licenses.scan(docs, spark.createDataFrame([("l", own[7])], "license string, text string")).where("size(notices) = 1").count() == 2


def fill(budget, kids):
    """Share budget among (weight, cap) children by weight, one saturated child at a time."""
    got, open_ = {}, dict(kids)
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, cap) in open_.items() if cap * total <= budget * w]
        if not full:
            return got | {k: budget * w // total for k, (w, _) in open_.items()}
        k = min(full, key=lambda k: (open_[k][1] / open_[k][0], k))
        got[k] = open_.pop(k)[1]
        budget -= got[k]
    return got


def test_budgets_go_to_siblings_before_ancestors(spark):
    p = mixing.Mix(levels=("d", "s"), weights={"d": {"x": 3, "y": 1}, "s": {"b": 2, "zero": 0}}, budget=1000, max_epochs=2)
    caps = {("x", "a"): 50, ("x", "b"): 400, ("x", "c"): 900, ("y", "a"): 1000, ("z", "a"): 5, ("z", "zero"): 70}
    leaves = spark.createDataFrame([(*k, v // 2 * 1 if v % 2 == 0 else v) for k, v in caps.items()], "level_0 string, level_1 string, tokens bigint")
    caps = {(r.level_0, r.level_1): 2 * r.tokens for r in leaves.collect()}
    caps["z", "zero"] = 0
    got = {(r.level_0, r.level_1): r.alloc for r in mixing.leaf_budgets(leaves, ["level_0", "level_1"], p).collect()}
    top = fill(1000, {d: ({"x": 3}.get(d, 1), sum(v for k, v in caps.items() if k[0] == d)) for d in "xyz"})
    want = {}
    for d in "xyz":
        kids = {k: ({"b": 2, "zero": 0}.get(k[1], 1), v) for k, v in caps.items() if k[0] == d}
        low = {k: v for k, v in kids.items() if v[0]}
        want |= fill(top[d], low)
        want |= {k: 0 for k in kids if k not in low}
    assert got == want and sum(got.values()) <= 1000


def test_prefix_matches_a_plain_sort(make_docs, odd_docs):
    import hashlib

    docs = make_docs([(i, prose(i, 1 + i % 23), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(400)])
    p = mixing.Mix(levels=("lang", "source"), weights={"source": {"hot": 5}}, percent=70, max_epochs=3)
    got = {r.doc_id: r.copies for r in mixing.select(docs, p).collect()}
    rows = [(r.doc_id, r.source, len(r.text.split())) for r in docs.collect()]
    total = {}
    for _, s, n in rows:
        total[s] = total.get(s, 0) + n
    share = fill(sum(total.values()) * 70 // 100, {s: (5 if s == "hot" else 1, 3 * n) for s, n in total.items()})
    want = {}
    for s, t in total.items():
        full, rest = divmod(share[s], t)
        key = lambda d: (int(hashlib.md5(f"17:{full}:{d}".encode()).hexdigest()[:15], 16), str(d))
        for d, _, n in sorted((r for r in rows if r[1] == s), key=lambda r: key(r[0])):
            rest -= n
            if full + (rest >= 0):
                want[d] = full + (rest >= 0)
    assert got == want
    odd = mixing.select(odd_docs, p)
    assert odd.columns == [*odd_docs.columns, "tokens", "copies"] and odd.count() > 0


def test_mixing_no_rows_and_no_budget(no_docs, odd_docs):
    p = mixing.Mix(levels=("lang", "source"))
    assert mixing.select(no_docs, p).count() == 0
    assert mixing.select(odd_docs, mixing.Mix(levels=("lang", "source"), budget=0)).count() == 0
    every = mixing.select(odd_docs, mixing.Mix(levels=("lang", "source"), percent=100, max_epochs=1))
    assert every.where("copies <> 1").count() == 0 and every.where("tokens > 0").count() == odd_docs.where(
        mixing.token_count(odd_docs["text"]) > 0).count()


def test_repeated_runs_go(make_docs, odd_docs, no_docs):
    run = [prose(60 + i, 9) for i in range(8)]
    passage = prose(99, 60)
    lines = lambda *x: "\n".join(x)
    a = lines(prose(1, 9), *run, prose(2, 9), passage)
    b = lines(prose(3, 9), prose(4, 30), *run[:3], "", *run[3:], prose(5, 9))
    c = lines(passage, prose(6, 9), passage, prose(7, 9))
    d = lines(*run[:2], prose(8, 9))  # too short a run
    docs = make_docs([(11, a), (12, b), (13, c), (14, d), (15, a), (15, a)])
    got = {r.doc_id: (r.text, r.removed) for r in line_dedup.dedup_lines(docs, to_removed="removed").collect()}
    assert got[11] == (a, 0) and got[14] == (d, 0)
    assert got[12] == (lines(prose(3, 9), prose(4, 30), "", prose(5, 9)), 8)
    assert got[13] == (lines(prose(6, 9), prose(7, 9)), 2) and got[15] == ("", 11)
    odd = line_dedup.dedup_lines(odd_docs)
    assert odd.columns == odd_docs.columns and odd.count() == odd_docs.count()
    assert sorted((r.doc_id or -1, r.text or "") for r in odd.collect()) == sorted(
        (r.doc_id or -1, "" if r.doc_id == 2 else r.text or "") for r in odd_docs.collect())
    assert line_dedup.dedup_lines(no_docs).count() == 0
