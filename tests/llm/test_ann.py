import numpy as np
import pytest

from lakemart.llm import ann as A

SF = "/root/testdata/sf0.01"


def brute(rows, queries, k):
    out = {}
    for q, x in queries:
        d = sorted((float(np.sqrt(((np.array(v) - np.array(x)) ** 2).sum())), i) for i, v in rows if i != q and len(v) == len(x))
        out[q] = d[:k]
    return out


def test_recall_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in df.collect()]
    ask = [r for r in rows if r[0] % 20 == 0]
    want = brute(rows, ask, 10)
    got = {}
    for r in A.search(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert all(len(got[q]) == 10 and got[q] == sorted(got[q]) for q in want)
    vectors = dict(rows)
    for q, found in got.items():
        assert all(s == float(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())) for s, i in found)
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9


def test_probes_go_by_score():
    low = np.array([0.1, 0.45, 0.8])
    steps = A.perturbations(low, 27)
    score = [sum((lo if s < 0 else 1 - lo) ** 2 for s, lo in zip(v, low) if s) for v in steps.tolist()]
    assert len({tuple(v) for v in steps.tolist()}) == 27 and score == sorted(score)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(30)] + [(100, None), (101, [0.0, 0.0]), (102, [None, 1.0]),
            (103, [float("nan"), 1.0]), (104, [float("inf"), 1.0]), (105, []), (106, [1.0, 2.0, 3.0]), (107, [1.0, 2.0, 4.0]),
            (None, [1.0, 1.0])]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, score int, v int")


def test_odd_rows_and_ties(odd):
    rows = A.search(odd, odd.where("vec_id in (0, 102, 105, 106, 107)")).collect()
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 106, 107]
    ties = [i for i in range(3, 30) if i % 3 == 0] + [1]
    assert sorted(got[0]) == [(k + 1, i, 0.0 if i % 3 == 0 else 1.0) for k, i in enumerate(ties)]
    assert got[106] == [(1, 107, 1.0)] and got[107] == [(1, 106, 1.0)]


def test_split_cells_change_nothing(odd):
    rows = lambda p: sorted(map(tuple, A.search(odd, odd.where("vec_id % 7 = 0"), p).collect()))
    assert rows(A.Ann(chunk=3)) == rows(A.Ann())


def test_no_rows(odd):
    assert A.search(odd.limit(0), odd.limit(0)).count() == 0
    assert A.search(odd, odd.limit(0)).count() == 0
