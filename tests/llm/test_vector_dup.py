import math

import numpy as np
import pytest

from lakemart.llm import queries as Q
from lakemart.llm import vector_dup as V

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, cell string, `a.b` string, component string"


def brute(rows, threshold=0.98):
    """(id, links, component, kept) of every row by comparing all pairs."""
    ok = []
    for i, (vid, v, label) in enumerate(rows):
        good = vid is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, float) if good else None)
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    unit = [None if v is None else (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for v in ok]
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if float(unit[i] @ unit[j]) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            r = find(i)
            low[r] = min(low.get(r, rows[i][0]), rows[i][0])
    out = []
    for i in range(n):
        c = low.get(find(i)) if rows[i][0] is not None else None
        out.append((rows[i][0], links[i], c, c is None or c == rows[i][0]))
    return sorted(out, key=str)


def collected(df):
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "c", "a.b", "k") for r in rows], SCHEMA)


def clusters(seed, groups, size, dim, spread):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        base = rng.normal(size=dim)
        base /= np.linalg.norm(base)
        for _ in range(rng.integers(1, size)):
            x = base + rng.normal(size=dim) * spread / math.sqrt(dim) * rng.uniform(0, 2)
            out.append((x * rng.uniform(0.01, 50)).tolist())
    return out


def test_whole_table(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert collected(Q.op11_embedding_dup(spark, SF)) == brute(rows)


@pytest.mark.parametrize("spread, p", [
    (0.1, V.VectorDup()), (0.2, V.VectorDup(block=32)), (0.05, V.VectorDup(block=16, sample=60)), (0.3, V.VectorDup(most_lists=4, codes=8))])
def test_no_link_is_lost(spark, spread, p):
    """Chains and groups at all distances around the threshold, few and many lists, small blocks."""
    vecs = clusters(int(spread * 100), 30, 40, 24, spread)
    rows = [(1000 + 7 * i % 911 + 1000 * (i % 2), v, i % 11 // 9) for i, v in enumerate(vecs)]
    assert collected(V.near_duplicates(frame(spark, rows), p)) == brute(rows)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1),
            (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (None, [1.0, 0.0], 1),
            (11, [1.0, 0.0, 0.0], 1), (12, [1e-300, 0.0], 1), (13, [1e300, 1e298], 1), (14, [1.0], 1), (15, [-1.0], 1), (16, [5.0], 1),
            (17, [-0.0, 1.0], 1), (18, [0.0, 1.0], 1), (None, None, None)]
    assert collected(V.near_duplicates(frame(spark, rows))) == brute(rows)
    none = V.near_duplicates(frame(spark, rows).limit(0))
    assert none.count() == 0 and none.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_mass_of_copies_and_near_copies(spark):
    """Two thirds of the rows: one vector many times, and one tight group."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, base.tolist(), 1) for i in range(300)]
    rows += [(1000 + i, (base + rng.normal(size=16) * 0.01).tolist(), 1) for i in range(300)]
    rows += [(2000 + i, rng.normal(size=16).tolist(), 1) for i in range(300)]
    assert collected(V.near_duplicates(frame(spark, rows), V.VectorDup(block=64))) == brute(rows)


def test_blocks_give_no_pairs(spark):
    """What leaves the comparison grows with rows and blocks, not with pairs."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    q = [(i, (base + rng.normal(size=16) * 0.1).tolist()) for i in range(200)]
    import pyarrow as pa
    t = pa.table({"label": [1] * 200, "dim": [16] * 200, "cell": pa.array([0] * 200, pa.int32()), "id": [i for i, _ in q], "copies": [1] * 200,
                  "v": [v for _, v in q], "codes": [b"\0"] * 200, "error": [1.0] * 200, "visits": pa.array([[0, 1]] * 200, pa.list_(pa.int32())),
                  "home": pa.array([0] * 200, pa.int32())})
    out = V._compare({}, V.VectorDup())(t, t)
    assert out.num_rows <= 3 * 200 and sum(out["links"].to_pylist()) > 5000


def test_lookup_bound_never_excludes_a_link():
    """Every pair within the link distance is within its lookup distance plus the quantisation error, and is visited."""
    u = V.unit(np.array(clusters(2, 60, 30, 32, 0.15)))
    book = V.fit(u[::3], 20, V.VectorDup(codes=16))
    at, codes, error = book.encode(u)
    margin = book.margins(u, at)
    cos = u @ u.T
    reach = math.sqrt(0.04)
    for i, j in zip(*np.nonzero(cos >= 0.98)):
        far = sum(t[0, codes[j, k]] for k, t in enumerate(book.tables(u[i:i + 1], at[j])))
        assert math.sqrt(max(far, 0)) <= reach + error[j] + 1e-9
        assert at[i] == at[j] or min(margin[i, at[j]], margin[j, at[i]]) <= reach / 2 + 1e-9
