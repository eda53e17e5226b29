"""Whitening of embeddings by the leading components of their covariance.

Spark sums the vectors and their centred products, one partial result a task;
the covariance (length x length, whatever the number of rows) is solved on the
driver by contour integration: complex shifted solves on a circle around the
wanted eigenvalues filter a random block of vectors onto their eigenspace, a
Rayleigh-Ritz step extracts the components, and inertia counts say how many
there must be.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.store import written
from lakemart.llm.vectors import by_length

SCALE = 1024
SHIFT = 100_000
# entries from here on have no exact fixed-point image and count as non-finite
TOO_LARGE = float(1 << 42)
BLOCK = 4096


# --- eigenvalues of a symmetric matrix in an interval


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``a`` (Householder reflections)."""
    a = a.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        a[k + 1:, k:] -= 2 * np.outer(x, x @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(tri: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """How many eigenvalues exceed ``shift``: positive pivots of the shifted matrix (its inertia)."""
    diag, off = tri
    tiny = np.finfo(float).tiny ** 0.5 * max(1.0, float(np.abs(diag).max()))
    pivot, above = 1.0, 0
    for i in range(len(diag)):
        pivot = diag[i] - shift - (off[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return int(above)


def _kth_largest(tri, k: int, low: float, high: float) -> float:
    """The k-th largest eigenvalue, by halving an interval that holds it."""
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if count_above(tri, mid) >= k:
            low = mid
        else:
            high = mid
    return low


def eigen_interval(v: np.ndarray, low: float, high: float, expected: int, nodes: int = 16, rounds: int = 300,
                   seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs of ``v`` inside (low, high), largest first; ``expected`` is their number by inertia.

    Raises if the subspace iteration ends with another number of them.
    """
    d = len(v)
    size = min(d, expected + max(8, expected // 2))
    y = np.random.default_rng([seed, d]).normal(size=(d, size))
    at, weight = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (1 - at)
    centre, radius = (low + high) / 2, (high - low) / 2
    step = radius * np.exp(1j * angle)
    # the matrix is real, so the lower half of the circle is the conjugate of the upper one
    inverse = [np.linalg.inv((centre + s) * np.eye(d) - v) for s in step]
    norm = np.abs(v).sum(axis=1).max()
    best, stalled, inside = np.inf, 0, np.zeros(0, dtype=int)
    for _ in range(rounds):
        q = sum(w * (s * (inv @ y)).real for w, s, inv in zip(weight, step, inverse))
        q, _ = np.linalg.qr(q)
        value, rot = np.linalg.eigh(q.T @ v @ q)
        y = q @ rot
        inside = np.flatnonzero((value > low) & (value < high))[::-1]
        left = np.abs(v @ y[:, inside] - y[:, inside] * value[inside]).max(initial=0.0)
        if len(inside) != expected:
            best, stalled = np.inf, 0
            continue
        # converged, or as good as rounding lets it become
        stalled = stalled + 1 if left > 0.9 * best else 0
        best = min(best, left)
        if left <= 4e-16 * norm or stalled >= 3:
            break
    if len(inside) != expected:
        raise ArithmeticError(f"{len(inside)} eigenvalues found, {expected} by inertia")
    return value[inside], y[:, inside]


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenpairs of a covariance, largest first; fewer if others are zero to working precision."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    scaled = v / trace
    tri = tridiagonal(scaled)
    floor = 1e-12
    wanted = most = min(k, count_above(tri, floor))
    first = _kth_largest(tri, 1, floor, 1.01)
    # the interval ends in a gap below the last component wanted; equal eigenvalues stay together
    edge = _kth_largest(tri, most, floor, 1.01)
    while most < count_above(tri, floor):
        after = _kth_largest(tri, most + 1, floor, 1.01)
        if edge - after > 1e-9:
            low = (edge + after) / 2
            break
        most, edge = most + 1, after
    else:
        low = floor / 2 if edge < 1e-9 else edge / 2
        low = max(low, floor)
    value, vector = eigen_interval(scaled, low, first + 0.05 * (first - low) + 1e-9, count_above(tri, low))
    return value[:wanted] * trace, vector[:, :wanted]


# --- passes over the vectors


def fixed_point(x: np.ndarray) -> np.ndarray:
    """``floor(1024 c) + 100000``, exactly."""
    return np.floor(SCALE * x).astype(np.int64) + SHIFT


def _clean(arr: pa.Array, dim: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, fixed-point vectors) without those that hold null, non-finite or too large entries, in blocks."""
    for rows, x in by_length(arr):
        if dim is None or x.shape[1] == dim:
            with np.errstate(invalid="ignore"):
                good = (np.abs(x) < TOO_LARGE).all(axis=1)
            rows, x = rows[good], fixed_point(x[good])
            for i in range(0, len(rows), BLOCK):
                yield rows[i:i + BLOCK], x[i:i + BLOCK]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: rows and the exact sum of every dimension."""
    total: dict[int, list] = {}
    for batch in batches:
        for _, x in _clean(batch.column(0)):
            got = total.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            got[0] += len(x)
            # |x| < 2**53 and at most 4096 rows: split in two, so that neither part can overflow
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            got[1] = [s + (h << 32) + w for s, h, w in zip(got[1], high, low)]
    rows = [(dim, i, n, Decimal(v)) for dim, (n, s) in total.items() for i, v in enumerate(s)]
    cols = list(zip(*rows)) if rows else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                      pa.array(cols[3], pa.decimal128(38))], names=["dim", "i", "n", "s"])


def _products(image: Callable[[np.ndarray], np.ndarray], dim: int, size: int):
    """Sums of products of all pairs of entries of ``image(x)``, one table a task."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((size, size))
        for batch in batches:
            for _, x in _clean(batch.column(0), dim):
                z = image(x)
                g += z.T @ z
        i, j = np.triu_indices(size)
        keep = g[i, j] != 0
        yield pa.RecordBatch.from_arrays([pa.array(i[keep], pa.int32()), pa.array(j[keep], pa.int32()),
                                          pa.array(g[i, j][keep])], names=["i", "j", "g"])

    return products


def _summed(vectors: DataFrame, image, dim: int, size: int) -> np.ndarray:
    rows = vectors.mapInArrow(_products(image, dim, size), "i int, j int, g double").groupBy("i", "j").agg(
        F.sum("g").alias("g")).collect()  # at most one row per pair of dimensions
    g = np.zeros((size, size))
    for r in rows:
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["g"]
    return g


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``n`` vectors, exact ``sums`` of their fixed-point images, and the leading components."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - sums`` as doubles; exact integers below 2**53."""
        nearest = np.array([round(s / self.n) if self.n else 0 for s in self.sums], dtype=np.int64)
        rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, nearest)], dtype=np.float64)
        return (x - nearest).astype(np.float64) * self.n - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates, one column a component."""
        return self.deviations(x) / self.n @ self.vectors / np.sqrt(self.values)

    def spread(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of squares of ``n x - sums``; None where a 64-bit integer cannot hold it."""
        z = self.deviations(x)
        if np.abs(z).max(initial=0.0) < 2.0 ** 31 / self.dim ** 0.5:
            return (z.astype(np.int64) ** 2).sum(axis=1).tolist()
        out = []
        for row in x.tolist():
            total = sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums))
            out.append(total if total < 1 << 63 else None)
        return out


def fit(vectors: DataFrame, components: int = 8, vec_col: str = "embedding") -> Whitening | None:
    """Leading components of the covariance (divisor n) of all vectors' fixed-point images; None without vectors.

    All rows of the table's most frequent length (the longest of several) are
    fitted. Null vectors and those with null, non-finite or huge (2**42)
    entries take no part; zero vectors and repeated rows count. Three scans:
    exact sums, centred products, products of the whitened rows, which give
    ``identity_error``. Entries are centred by the whole number nearest the
    mean before they are multiplied, so the products are exact in doubles, and
    the covariance follows with the remaining fraction.
    """
    src = vectors.select(F.col(f"`{vec_col}`").alias("v"))
    part = written(src.mapInArrow(_sums, "dim int, i int, n bigint, s decimal(38,0)"), "vector_sums")
    top = part.where("i = 0").groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not top:
        return None
    dim, n = top[0]["dim"], int(top[0]["n"])
    total = {r["i"]: int(r["s"]) for r in part.where(F.col("dim") == dim).groupBy("i").agg(F.sum("s").alias("s")).collect()}
    sums = tuple(total[i] for i in range(dim))
    near = np.array([round(s / n) for s in sums], dtype=np.int64)
    rest = np.array([(s - n * int(m)) / n for s, m in zip(sums, near)])
    cov = _summed(src, lambda x: (x - near).astype(np.float64), dim, dim) / n - np.outer(rest, rest)
    values, axes = leading(cov, components)
    model = Whitening(n, sums, values, axes, float(np.trace(cov)), 0.0)
    if not len(values):
        return model
    white = _summed(src, model.project, dim, len(values)) / n
    return Whitening(n, sums, values, axes, model.trace, float(np.abs(white - np.eye(len(values))).max()))


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id_col, deviation, whitened`` for every row that ``fit`` would use.

    ``deviation`` is the exact sum of squares of ``n x - sums`` (null beyond 64
    bits), ``whitened`` the array of whitened coordinates, largest component
    first. Rows with a null or repeated id are kept as they are; other columns
    are ignored.
    """
    kept = vectors.schema[id_col]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _clean(batch.column(1), model.dim):
                w = model.project(x)
                flat = pa.array(w.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array(model.spread(x), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), flat)],
                    names=["id", "deviation", "whitened"])

    out = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("v")).mapInArrow(
        rows, f"id {kept.dataType.simpleString()}, deviation bigint, whitened array<double>")
    return out.withColumnRenamed("id", id_col)


def whitened_components(vectors: DataFrame, components: int = 8, id_col: str = "vec_id",
                        vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component: ``id_col, component, n, deviation, whitened, explained, identity_error``.

    Components are numbered from 1 by falling eigenvalue; those whose
    eigenvalue is zero to working precision are left out (a table of equal
    vectors gives no row). ``explained`` is the eigenvalue's share of the
    trace. An empty table gives no row.
    """
    model = fit(vectors, components, vec_col)
    names = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        spark = vectors.sparkSession
        return spark.createDataFrame([], f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, {names}")
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    out = transform(vectors, model, id_col, vec_col).select(F.col(f"`{id_col}`"), "deviation", F.posexplode("whitened").alias("i", "w"))
    return out.select(F.col(f"`{id_col}`"), (F.col("i") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                      "deviation", F.col("w").alias("whitened"), F.element_at(share, F.col("i") + 1).alias("explained"),
                      F.lit(model.identity_error).alias("identity_error"))
