import numpy as np
import pyarrow as pa

from lakemart.llm import near_dup
from lakemart.llm.components import connected_components
from lakemart.llm.near_dup import NearDup
from tests.llm.conftest import prose


def shingles(text, n):
    w = (text or "").split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, p):
    sets = {d: shingles(t, p.shingle) for d, t in rows}
    low = {d: d for d in sets}
    again = True
    while again:
        again = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= p.threshold_pct * len(sets[a] | sets[b]) and low[a] > low[b]:
                    low[a], again = low[b], True
    return {d: (len(sets[d]), low[d], low[d] == d) for d in sets}


def edited(text, every, tag):
    return " ".join(f"{tag}{i}" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def test_groups_match_brute_force(make_docs):
    p = NearDup(shingle=3, threshold_pct=85)
    base = prose(3, 300)
    rows = [(10 + i, prose(50 + i, 60 + i)) for i in range(20)]
    rows += [(100 + i, edited(base, 40 + 7 * i, f"e{i}x")) for i in range(25)]  # some pairs pass, some do not
    rows += [(200 + i, base) for i in range(12)]
    chain = prose(4, 200).split()
    rows += [(300 + i, " ".join(chain[4 * i:4 * i + 120])) for i in range(10)]  # only neighbours are similar
    rows += [(5, "one two"), (6, "one two"), (7, ""), (8, None)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(make_docs(rows), p).collect()}
    assert got == brute(rows, p)


def test_odd_rows(odd_docs):
    rows = near_dup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(76, 1, True)] and by[2] == [(76, 1, False)] * 2
    assert by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)] and by[5] == [(0, 5, True)]
    assert by[6] == [(1, 6, True)] and by[10] == [(1, 10, True)]
    assert {x[1:] for x in by[None]} == {(None, True)}
    kept = near_dup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 1, 3, 4, 5, 6, 7, 9, 10]


def test_no_rows(no_docs):
    assert near_dup.near_duplicates(no_docs).count() == 0


def test_sketch_estimates_similarity(spark):
    p = NearDup()
    texts = [prose(1, 400), edited(prose(1, 400), 50, "x"), edited(prose(1, 400), 25, "y")]
    sets = [set(s.tolist()) for s in near_dup.shingle_sets(pa.array(texts), p.shingle)]
    df = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    sig = near_dup.signature(p)
    rows = df.select(sig("a").alias("x"), sig("b").alias("y")).select(
        near_dup.sketch_similarity(near_dup.F.col("x.sketch"), near_dup.F.col("y.sketch"), p).alias("j")).collect()
    true = [len(a & b) / len(a | b) for a in sets for b in sets]
    assert np.abs(np.array([r.j for r in rows]) - true).max() < p.slack


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, **{i: 100 for i in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
