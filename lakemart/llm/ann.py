"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each table hashes a vector to the cell ``floor((A x + b) / w)`` of Gaussian
projections. A query visits its own cell and perturbed cells in the order of
their estimated success: the smaller the squared distances to the cell
borders it has to cross, the likelier a neighbour lies there. All candidates
of all tables are reranked by exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm import text as T
from lakemart.llm.store import written

_U = np.uint64


@dataclass(frozen=True)
class Ann:
    """Parameters.

    ``width`` is the cell width in standard deviations of a projection.
    ``probes`` cells are visited in each table; None finds the number that
    reaches ``target`` recall on a bounded sample of ``sample`` vectors
    (a sample's neighbours are farther away, so the whole index does better).
    ``chunk``: a cell with more vectors is split into parts of about this size.
    """

    k: int = 10
    tables: int = 4
    projections: int = 6
    width: float = 2.0
    probes: int | None = None
    target: float = 0.95
    sample: int = 3000
    chunk: int = 20_000
    seed: int = 3


def usable(v: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def _projected(x: np.ndarray, scale: float, p: Ann) -> np.ndarray:
    """Positions in units of the cell width, (rows, tables, projections)."""
    rng = np.random.default_rng([p.seed, x.shape[1]])
    a = rng.normal(size=(x.shape[1], p.tables * p.projections))
    b = rng.uniform(size=p.tables * p.projections)
    return (x @ a / (p.width * scale) + b).reshape(len(x), p.tables, p.projections)


def _cell(at: np.ndarray, dim: int, p: Ann) -> np.ndarray:
    """Key of integer cells (..., tables, projections); tables and dimensions never share one."""
    key = T.mix(np.arange(1, p.tables + 1, dtype=np.uint64) * _U(1 << 32) + _U(dim))
    key = np.broadcast_to(key, at.shape[:-1])
    for j in range(p.projections):
        key = T.mix(key * _U(0x9E3779B97F4A7C15) + at[..., j].astype(np.int64).view(np.uint64))
    return key.view(np.int64)


def perturbations(low: np.ndarray, probes: int) -> np.ndarray:
    """The first ``probes`` steps off a cell, best first; ``low``: distances to its lower borders, 0 to 1.

    A step moves some projections by one cell; its score is the sum of the
    squared distances to the borders crossed. Sets over the sorted border
    distances grow by adding the next border or moving the last one on.
    """
    m = len(low)
    cost = np.concatenate([low ** 2, (1 - low) ** 2])
    order = np.argsort(cost, kind="stable")
    cost = cost[order].tolist()
    where, way = (order % m).tolist(), np.where(order < m, -1, 1).tolist()
    out = np.zeros((probes, m), dtype=np.int64)
    heap, n = [(cost[0], (0,))], 1
    while heap and n < probes:
        c, picks = heapq.heappop(heap)
        last = picks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (c - cost[last] + cost[last + 1], picks[:-1] + (last + 1,)))
            heapq.heappush(heap, (c + cost[last + 1], picks + (last + 1,)))
        if len({where[i] for i in picks}) == len(picks):
            for i in picks:
                out[n, where[i]] = way[i]
            n += 1
    return out[:n]


def probe_cells(x: np.ndarray, scale: float, probes: int, p: Ann) -> list[np.ndarray]:
    """For each row, the cells to visit in visiting order (steps, tables)."""
    at = _projected(x, scale, p)
    cell = np.floor(at)
    out = []
    for i in range(len(x)):
        steps = [perturbations(at[i, t] - cell[i, t], probes) for t in range(p.tables)]
        n = min(map(len, steps))
        out.append(_cell(cell[i][None].astype(np.int64) + np.stack([s[:n] for s in steps], axis=1), x.shape[1], p))
    return out


def distances(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances of one vector to many, in double precision."""
    return np.sqrt(((v - q) ** 2).sum(axis=1))


def calibrate(x: np.ndarray, scale: float, p: Ann) -> int:
    """Fewest probes that find the target share of true neighbours within the sample."""
    most = 3 ** min(p.projections, 6)
    q = np.arange(0, len(x), max(1, len(x) // 100))[:100]
    cells = _cell(np.floor(_projected(x, scale, p)).astype(np.int64), x.shape[1], p)
    need = []
    for i, visited in zip(q.tolist(), probe_cells(x[q], scale, most, p)):
        d = distances(x[i], x)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(p.k, len(x) - 1)]
        hit = visited[:, None, :] == cells[near][None]  # steps x neighbours x tables
        need.extend(np.where(hit.any(axis=(0, 2)), hit.any(axis=2).argmax(axis=0) + 1, most).tolist())
    return int(np.quantile(need, p.target, method="higher")) if need else 1


def _matrix(arr: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of the vectors of a list array."""
    n = np.asarray(arr.value_lengths())
    flat = np.asarray(arr.flatten(), dtype=np.float64)
    first = np.cumsum(n) - n
    for dim in np.unique(n).tolist():
        rows = np.flatnonzero(n == dim)
        yield rows, flat[first[rows][:, None] + np.arange(dim)]


def _keys_udf(scale: float, p: Ann):
    @F.arrow_udf("array<bigint>")
    def keys(v: pa.Array) -> pa.Array:
        out = np.zeros((len(v), p.tables), dtype=np.int64)
        for rows, x in _matrix(v):
            out[rows] = _cell(np.floor(_projected(x, scale, p)).astype(np.int64), x.shape[1], p)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * p.tables), pa.array(out.ravel()))

    return keys


def _probes_udf(scale: float, probes: int, p: Ann):
    @F.arrow_udf("array<bigint>")
    def cells(v: pa.Array) -> pa.Array:
        out: list = [None] * len(v)
        for rows, x in _matrix(v):
            for i, c in zip(rows.tolist(), probe_cells(x, scale, probes, p)):
                out[i] = c.ravel()
        return pa.array(out, type=pa.list_(pa.int64()))

    return cells


def _nearest_in_cell(k: int):
    """For one part of a cell: each visiting query's k nearest vectors there, by exact distance."""

    def nearest(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if queries.num_rows and vectors.num_rows:
            vid, qid = (np.asarray(t["vec_id"]) for t in (vectors, queries))
            v, q = (np.asarray(t["v"].combine_chunks().flatten()).reshape(t.num_rows, -1) for t in (vectors, queries))
            size = (v * v).sum(axis=1)
            for i in range(0, len(q), 256):
                part = q[i:i + 256]
                rough = size[None] - 2 * part @ v.T + (part * part).sum(axis=1)[:, None]
                rough[qid[i:i + 256][:, None] == vid[None]] = np.inf
                edge = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(v) > k else np.full(len(part), np.inf)
                slack = 1e-9 * (size.max() + (part * part).sum(axis=1))
                for j in range(len(part)):
                    c = np.flatnonzero((rough[j] <= edge[j] + slack[j]) & (rough[j] < np.inf))
                    d = distances(part[j], v[c])
                    best = np.lexsort((vid[c], d))[:k]
                    out_q.append(np.full(len(best), qid[i + j])), out_v.append(vid[c][best]), out_s.append(d[best])
        cat = lambda x, t: pa.array(np.concatenate(x) if x else [], type=t)
        return pa.table({"query_id": cat(out_q, pa.int64()), "vec_id": cat(out_v, pa.int64()),
                         "score": cat(out_s, pa.float64())})

    return nearest


def _search_cells(queries: DataFrame, vectors: DataFrame, p: Ann) -> DataFrame:
    """Nearest vectors per cell: ``queries(vec_id, v, cell)`` against ``vectors(vec_id, v, cell)``.

    A cell with many vectors is split by hash of the id, and its queries go to every part.
    """
    parts = vectors.groupBy("cell").agg(F.count("*").alias("n")).select(
        "cell", F.ceil(F.col("n") / p.chunk).cast("int").alias("parts")).where("parts > 1")
    vec = vectors.join(parts, "cell", "left").withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1)))).select("cell", "part", "vec_id", "v")
    que = queries.join(parts, "cell", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.coalesce("parts", F.lit(1)) - 1).cast("bigint")))
    ).select("cell", "part", "vec_id", "v")
    return que.groupby("cell", "part").cogroup(vec.groupby("cell", "part")).applyInArrow(
        _nearest_in_cell(p.k), "query_id bigint, vec_id bigint, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.distinct().groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("i", "x")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def search(vectors: DataFrame, queries: DataFrame, p: Ann = Ann(), id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found among ``vectors``, nearest first.

    Ties go to the smaller id; a row with the query's own id is no candidate.
    Vectors that are null, zero or hold null or non-finite components and
    rows with a null id take no part; vectors of different lengths are never
    compared. A query for which the cells visited hold too few vectors is
    answered by an exact scan. Ids that occur twice with different vectors
    are two candidates. Other columns are ignored.
    """
    def clean(df):
        return df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")
                         ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))

    base, ask = clean(vectors), clean(queries)
    sample = [np.array(r["v"]) for r in base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(p.sample).collect()]
    scale, probes = 1.0, p.probes or 1
    if sample:
        dims = [len(x) for x in sample]
        x = np.stack([s for s in sample if len(s) == max(set(dims), key=lambda d: (dims.count(d), d))])
        # a projection's deviation over the data is the root mean square of the centred coordinates' norm
        scale = float(np.sqrt(((x - x.mean(axis=0)) ** 2).sum(axis=1).mean())) or float(np.abs(x).max())
        if p.probes is None:
            probes = calibrate(x, scale, p)
    cells = base.select("vec_id", "v", F.explode(_keys_udf(scale, p)("v")).alias("cell"))
    visits = ask.select("vec_id", "v", F.explode(F.array_distinct(_probes_udf(scale, probes, p)("v"))).alias("cell"))
    # cells without vectors need no visit
    visits = visits.join(cells.select("cell").distinct(), "cell", "left_semi")
    found = written(_search_cells(visits, cells, p), "neighbours")
    total = base.groupBy(F.size("v").alias("dim")).agg(F.count_distinct("vec_id").alias("n"))
    short = ask.withColumn("dim", F.size("v")).join(total, "dim").join(
        found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count_distinct("vec_id").alias("got")), "vec_id", "left"
    ).where(F.coalesce("got", F.lit(0)) < F.least(F.lit(p.k), F.col("n") - 1)).select("vec_id", "v")
    short = written(short, "short_queries")
    if short.limit(1).count():
        by_dim = F.size("v").cast("bigint").alias("cell")
        found = found.unionByName(_search_cells(short.select("vec_id", "v", by_dim), base.select("vec_id", "v", by_dim), p))
    return _ranked(found, p.k)
