import numpy as np
import pytest

from lakemart.llm import queries as Q
from lakemart.llm import whitening as W

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>, label int, i string, n string, `a.b` string, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", "n", "a.b", "w") for r in rows], SCHEMA)


def expected(vectors, k=8):
    """Everything by plain arithmetic: integers for the deviations, a dense eigensolver for the components."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * c - t) ** 2 for c, t in zip(row, s)) for row in x]
    z = np.array([[(n * c - t) / n for c, t in zip(row, s)] for row in x])
    cov = z.T @ z / n
    value, axes = np.linalg.eigh(cov)
    value, axes = value[::-1][:k], axes[:, ::-1][:, :k]
    return n, dev, value, z @ axes / np.sqrt(value), np.trace(cov)


def test_whole_table(spark):
    rows = {r["vec_id"]: list(r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(rows)
    n, dev, value, white, trace = expected([rows[i] for i in ids])
    got = Q.op13_whitening(spark, SF).toPandas()
    assert len(got) == 8 * n and set(got.n) == {n}
    assert got.groupby("vec_id").deviation.first().loc[ids].tolist() == dev
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((w * white).sum(axis=0))
    assert np.abs(w * sign - white).max() < 1e-9
    share = got.groupby("component").explained.first().to_numpy()
    assert np.abs(share / (value / trace) - 1).max() < 1e-12
    assert got.identity_error.nunique() == 1 and 0 <= got.identity_error[0] < 1e-9
    assert np.abs(w.T @ w / n - np.eye(8)).max() < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 1.0, -1.0]), (2, [0.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0]), (None, [3.0, -2.5, 0.001]), (5, [0.5, 1.0, -1.0]), (6, [9.0, 1.0, 1.0])]
    bad = [(10, None), (11, []), (12, [nan, 0.0, 0.0]), (13, [inf, 0.0, 0.0]), (14, [None, 0.0, 0.0]), (15, [1e300, 0.0, 0.0]), (16, [1.0, 2.0])]
    got = W.whitened_components(frame(spark, good + bad)).toPandas()
    n, dev, value, white, trace = expected([v for _, v in good])
    assert len(got) == 3 * len(good) and set(got.component) == {1, 2, 3}
    assert sorted(got[got.component == 1].deviation) == sorted(dev)
    assert np.allclose(np.sort(np.abs(got.whitened)), np.sort(np.abs(white).ravel()), atol=1e-12)
    assert got.vec_id.isna().sum() == 3


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_spread_gives_no_row(spark, rows):
    out = W.whitened_components(frame(spark, rows or [(1, [1.0])]).where(f"{len(rows)} > 0"))
    assert out.count() == 0
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_64_bits():
    m = W.Whitening(1 << 40, (5 << 40,), np.ones(1), np.ones((1, 1)), 1.0, 0.0)
    assert m.spread(np.array([[5], [6]])) == [0, None]
    m = W.Whitening(1 << 31, (5 << 31,), np.ones(1), np.ones((1, 1)), 1.0, 0.0)
    assert m.spread(np.array([[5], [6], [7]])) == [0, 1 << 62, None]


@pytest.mark.parametrize("value", [
    np.linspace(1, 50, 30), np.array([5.0] * 4 + [1.0] * 20), np.array([7.0] * 12), np.geomspace(1, 1e-8, 20),
    np.array([3.0, 2.0, 1.0] + [1e-20] * 10), np.array([10.0] + [1.0, 1.0 - 1e-11] * 9), np.array([2.0])])
def test_contour_integration_finds_the_leading_components(value):
    rng = np.random.default_rng(len(value))
    q, _ = np.linalg.qr(rng.normal(size=(len(value), len(value))))
    v = (q * value) @ q.T
    v = (v + v.T) / 2
    got, axes = W.leading(v, 8)
    want = np.sort(value)[::-1][:8]
    want = want[want > 1e-12 * value.sum()]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-7, atol=1e-14 * value.max())
    assert np.abs(axes.T @ axes - np.eye(len(got))).max() < 1e-12
    assert np.abs(v @ axes - axes * got).max() < 1e-12 * value.max()


def test_inertia_counts():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(25, 25))
    a = a + a.T
    tri = W.tridiagonal(a)
    value = np.linalg.eigvalsh(a)
    for shift in np.linspace(value[0] - 1, value[-1] + 1, 101):
        assert W.count_above(tri, shift) == (value > shift).sum()


def test_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError):
        W.eigen_interval(np.diag([1.0, 2.0, 3.0]), 1.5, 3.5, 3)
