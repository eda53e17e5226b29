"""Near-duplicate embeddings by product quantisation, without losing a link.

Vectors of length one are dealt to coarse inverted lists (nearest centroid).
Two vectors at distance r from each other lie in one list or at least one of
them lies within r/2 of the plane between the two centroids, so visiting the
lists whose plane is that near is sufficient. In a list, a query's distance
to a vector's subspace code is looked up from its tables; a vector whose code
is farther than the link distance plus its own quantisation error cannot be
linked. What passes is decided by the exact cosine.

Vectors within half the link angle of their centroid are linked with each
other by the triangle inequality, so a mass of near copies is counted, not
compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.ann import usable
from lakemart.llm.components import connected_components
from lakemart.llm.store import written
from lakemart.llm.vectors import by_length

# rounding of distances and angles never decides: bounds are wider by this
SLACK = 1e-6


@dataclass(frozen=True)
class VectorDup:
    """Parameters.

    ``threshold``: least cosine of a link. Codebooks are fitted on ``sample``
    vectors at most; there are about ``sqrt(rows) / 4`` lists, ``most_lists``
    at most. ``subspaces`` codes of ``codes`` words describe a residual.
    ``block``: rows compared at once; longer lists are split into blocks.
    """

    threshold: float = 0.98
    sample: int = 16_384
    most_lists: int = 1024
    subspaces: int = 8
    codes: int = 256
    rounds: int = 8
    block: int = 4096
    seed: int = 11


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow or underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact cosine of each row of ``a`` with the same row of ``b``, the same whichever comes first."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` centroids; each first one is drawn by its distance from those before, an empty one stays."""
    k = min(k, len(x))
    centre = [x[rng.integers(len(x))]]
    far = ((x - centre[0]) ** 2).sum(axis=1)
    while len(centre) < k and far.sum() > 0:
        centre.append(x[rng.choice(len(x), p=far / far.sum())])
        far = np.minimum(far, ((x - centre[-1]) ** 2).sum(axis=1))
    c = np.array(centre)
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)


@dataclass(frozen=True)
class Codebook:
    """Centroids of the lists and, per subspace, words of the residuals."""

    lists: np.ndarray
    cuts: list[slice]
    words: list[np.ndarray]

    def encode(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and quantisation error of each row."""
        at = nearest(u, self.lists)
        rest = u - self.lists[at]
        codes = np.stack([nearest(rest[:, c], w) for c, w in zip(self.cuts, self.words)], axis=1).astype(np.uint8)
        for j, (c, w) in enumerate(zip(self.cuts, self.words)):
            rest[:, c] -= w[codes[:, j]]
        return at, codes, np.sqrt((rest * rest).sum(axis=1))

    def margins(self, u: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distance of each row from the plane between its own and every other centroid (rows, lists)."""
        d2 = (self.lists ** 2).sum(axis=1)[None] - 2 * u @ self.lists.T
        apart = np.sqrt(np.maximum(((self.lists[at][:, None] - self.lists[None]) ** 2).sum(axis=2), 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            m = (d2 - d2[np.arange(len(u)), at][:, None]) / (2 * apart)
        # equal centroids have no plane between them
        return np.where(apart > 0, m, 0.0)

    def tables(self, q: np.ndarray, at: int) -> list[np.ndarray]:
        """Squared distances of each query's residual to the words, per subspace (queries, words)."""
        rest = q - self.lists[at]
        return [((rest[:, c] ** 2).sum(axis=1)[:, None] - 2 * rest[:, c] @ w.T + (w * w).sum(axis=1)[None])
                for c, w in zip(self.cuts, self.words)]


def fit(u: np.ndarray, lists: int, p: VectorDup) -> Codebook:
    rng = np.random.default_rng([p.seed, u.shape[1]])
    c = kmeans(u, lists, p.rounds, rng)
    rest = u - c[nearest(u, c)]
    parts = [s for s in np.array_split(np.arange(u.shape[1]), p.subspaces) if len(s)]
    cuts = [slice(int(s[0]), int(s[-1]) + 1) for s in parts]
    return Codebook(c, cuts, [kmeans(rest[:, s], p.codes, p.rounds, rng) for s in cuts])


def _plain(dim: int) -> Codebook:
    """One list and one word a subspace, for a length that the sample does not hold."""
    return Codebook(np.zeros((1, dim)), [slice(0, dim)], [np.zeros((1, dim))])


INDEXED = "struct<cell:int,visits:array<int>,codes:binary,error:double>"


def _index_udf(books: dict[int, Codebook], p: VectorDup):
    reach = np.sqrt(2 - 2 * p.threshold) / 2 + SLACK
    core = np.cos(np.arccos(p.threshold) / 2 - SLACK)

    @F.arrow_udf(INDEXED)
    def index(v: pa.Array) -> pa.Array:
        out: list = [None] * len(v)
        for rows, x in by_length(v):
            book = books.get(x.shape[1]) or _plain(x.shape[1])
            for i in range(0, len(x), 1024):
                u = unit(x[i:i + 1024])
                at, codes, error = book.encode(u)
                c = book.lists[at]
                size = np.sqrt((c * c).sum(axis=1))
                inner = (u * c).sum(axis=1) >= core * np.where(size > 0, size, np.inf)
                near = book.margins(u, at) <= reach
                near[np.arange(len(u)), at] = True
                for r, a, k, code, e, m in zip(rows[i:i + 1024].tolist(), at.tolist(), inner.tolist(), codes, error.tolist(), near):
                    visits = [2 * x + half for x in np.flatnonzero(m).tolist() for half in (0, 1) if not (k and x == a and half)]
                    out[r] = {"cell": 2 * a + k, "visits": visits, "codes": code.tobytes(), "error": e}
        return pa.array(out, type=pa.struct([("cell", pa.int32()), ("visits", pa.list_(pa.int32())), ("codes", pa.binary()),
                                             ("error", pa.float64())]))

    return index


def _smallest_reachable(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 with links a-b: the smallest id of each node's component."""
    low = ids.copy()
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, new[a])
        if (new == low).all():
            return low
        low = new


def _compare(books: dict[int, Codebook], p: VectorDup):
    """Links between the queries that visit a block of a list and its vectors: counts, and a spanning set of links."""
    reach = np.sqrt(2 - 2 * p.threshold) + SLACK

    def compare(queries: pa.Table, members: pa.Table) -> pa.Table:
        ids, count, a, b = [], [], [], []
        if queries.num_rows and members.num_rows:
            qid, mid = (np.asarray(t["id"]) for t in (queries, members))
            qw, mw = (np.asarray(t["copies"]) for t in (queries, members))
            q, m = (next(by_length(t["v"]))[1] for t in (queries, members))
            cell = members["cell"][0].as_py()
            book = books.get(m.shape[1]) or _plain(m.shape[1])
            codes = np.frombuffer(b"".join(members["codes"].to_pylist()), np.uint8).reshape(len(m), -1)
            limit = (reach + np.asarray(members["error"])) ** 2
            home = np.asarray(queries["home"])
            visits = members["visits"].combine_chunks()
            flat, ends = np.asarray(visits.flatten()), np.cumsum(np.asarray(visits.value_lengths()))
            # (member, cell it visits) pairs as single numbers
            seen = np.unique(np.repeat(np.arange(len(m)), np.diff(ends, prepend=0)) * (1 << 32) + flat)
            hits_q, hits_m = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            u = unit(q)
            for i in range(0, len(q), 256):
                tables = book.tables(u[i:i + 256], cell // 2)
                far = sum(t[:, codes[:, j]] for j, t in enumerate(tables))
                x, y = np.nonzero(far <= limit[None])
                x += i
                for k in range(0, len(x), 1 << 16):
                    xs, ys = x[k:k + (1 << 16)], y[k:k + (1 << 16)]
                    good = (cosines(q[xs], m[ys]) >= p.threshold) & (qid[xs] != mid[ys])
                    hits_q.append(xs[good]), hits_m.append(ys[good])
            x, y = np.concatenate(hits_q), np.concatenate(hits_m)
            to_q = np.bincount(x, weights=mw[y], minlength=len(q)).astype(np.int64)
            # a member that visits the query's own cell counts the link there
            there = np.isin(y.astype(np.int64) * (1 << 32) + home[x], seen)
            to_m = np.bincount(y[~there], weights=qw[x[~there]], minlength=len(m)).astype(np.int64)
            every, back = np.unique(np.concatenate([qid, mid]), return_inverse=True)
            root = _smallest_reachable(every, back[x], back[len(q) + y])
            ids = np.concatenate([qid, mid, every])
            count = np.concatenate([to_q, to_m, np.zeros(len(every), np.int64)])
            b = np.concatenate([qid, mid, root])
            keep = (count > 0) | (b != ids)
            ids, count, b = ids[keep], count[keep], b[keep]
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(count, pa.int64()), "low": pa.array(b, pa.int64())})

    return compare


def _blocks(rows: DataFrame, key: list[str], count: DataFrame, mine: str, other: str) -> DataFrame:
    """Rows dealt to the blocks of their cell: one of ``mine`` parts by id, sent to each of the ``other`` parts."""
    part = F.pmod(F.xxhash64("id"), F.col(f"n_{mine}"))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"n_{other}") - 1))
    return rows.join(count, key).withColumn(mine, part).withColumn(other, each).drop(f"n_{mine}", f"n_{other}")


def near_duplicates(vectors: DataFrame, p: VectorDup = VectorDup(), id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: ``id_col, n_links, component_id, kept``.

    Rows are linked if their labels are equal and not null and their cosine is
    ``threshold`` or more. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` marks the row that
    carries it. Vectors that are null, zero or hold null or non-finite
    components, and those of a null label, link with nothing; vectors of
    different lengths are never linked. A row with a null id takes no part:
    no links, component null, kept true. Rows that repeat an id are rows of
    their own. Other columns are ignored; an empty table gives no row.

    Equal vectors are one row with a number of copies in all passes. Codebooks
    are fitted on a bounded sample and sent with the tasks; every vector is
    indexed and no link is lost, whatever the sample. Rows leave a block as
    one count and one link each, never as pairs.
    """
    src = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").alias("label"),
                         F.col(f"`{vec_col}`").alias("v"))
    good = src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    same = ["label", "h1", "h2"]
    hashed = good.select("id", "label", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(p.seed), "v").alias("h2"), "v")
    classes = written(hashed.groupBy(*same).agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("v").alias("v")),
                      "vector_classes")
    n = classes.count()
    chosen = [np.array(r["v"], dtype=np.float64) for r in classes.orderBy(F.xxhash64("h1"), "h1", "h2", "label").limit(p.sample).select("v").collect()]
    lists = int(min(p.most_lists, max(1, np.sqrt(n) / 4)))
    books = {dim: fit(unit(np.stack([x for x in chosen if len(x) == dim])), lists, p) for dim in {len(x) for x in chosen}}

    ready = classes.select("id", "label", "copies", "v", F.size("v").alias("dim"), _index_udf(books, p)("v").alias("i"))
    ready = written(ready.select("id", "label", "copies", "v", "dim", "i.*"), "vector_index")
    key = ["label", "dim", "cell"]
    members = ready.select(*key, "id", "copies", "v", "codes", "error", "visits")
    queries = ready.select("label", "dim", F.explode("visits").alias("cell"), "id", "copies", "v", F.col("cell").alias("home"))
    parts = lambda name: F.ceil(F.count("*") / p.block).cast("bigint").alias(name)
    count = members.groupBy(*key).agg(parts("n_m")).join(
        ready.select("label", "dim", F.explode("visits").alias("cell")).groupBy(*key).agg(parts("n_q")), key)
    blocks = [*key, "q", "m"]
    left, right = _blocks(queries, key, count, "q", "m"), _blocks(members, key, count, "m", "q")
    left = left.toDF(*left.columns)  # columns of its own: both sides come from one table
    found = written(left.groupby(*blocks).cogroup(right.groupby(*blocks)).applyInArrow(
        _compare(books, p), "id bigint, links bigint, low bigint"), "vector_links")

    # the inner half of a list: all linked with one another
    cores = ready.where("cell % 2 = 1").groupBy(*key).agg(F.sum("copies").alias("total"), F.min("id").alias("low"))
    core = ready.where("cell % 2 = 1").select("id", "copies", *key).join(cores, key).select(
        "id", (F.col("total") - F.col("copies")).alias("links"), "low")
    links = found.unionByName(core)
    total = links.groupBy("id").agg(F.sum("links").alias("links"))
    comp = connected_components(links.select(F.col("id").alias("a"), F.col("low").alias("b")))
    known = classes.select(*same, "id", "copies").join(total, "id", "left").join(
        comp.select(F.col("node").alias("id"), "component"), "id", "left").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))

    member = hashed.select("id", *same).join(known, same).select("id", "n_links", "component")
    alone = src.where(~(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(usable(F.col("v")), F.lit(False)))).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return member.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
