"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every word is predicted from the words on both sides of it: the network adds
one learned vector per neighbour and side, passes the sum through tanh and
gives a softmax over word classes; the word's share of its class comes from
counts over the whole corpus. The sum of the log-probabilities of all words,
each conditioned on its neighbours, scores the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm import text as T
from lakemart.llm.blas import one_thread
from lakemart.llm.store import columns, free_name, written

_U = np.uint64
_FIXED = float(1 << 24)
_SAFE = 60.0  # sums of exps up to here, and their shares, are ordinary float32 numbers


@dataclass(frozen=True)
class Lm:
    """Parameters.

    ``vocabulary`` most frequent words have vectors of their own, the others
    share ``tail_inputs`` vectors; this bounds the network. Classes: ``single``
    most frequent words alone, ``middle`` classes of about equal mass, and
    ``tail`` classes by hash for words outside the vocabulary. Every word,
    inside or outside it, has its own share of its class, from its count in
    the whole corpus; that table of counts grows with the corpus.
    ``side`` words on each side are read. Training runs ``rounds`` times
    over all documents: each task trains on its own rows, then the parameters
    are averaged, a word's vector over the tasks that met it by how often. A ``share`` below 1 trains on that part of the rows, drawn
    row by row, copies of a text one by one.
    """

    vocabulary: int = 8192
    tail_inputs: int = 512
    single: int = 48
    middle: int = 32
    tail: int = 16
    side: int = 3
    embed: int = 16
    hidden: int = 24
    share: float = 1.0
    rounds: int = 2
    batch: int = 1024
    rate: float = 0.08
    seed: int = 5


def _shapes(p: Lm) -> list[tuple[int, ...]]:
    classes = p.single + p.middle + p.tail
    inputs = p.vocabulary + p.tail_inputs + 1  # the last stands for what lies outside a document
    return [(inputs, p.embed), (2 * p.side, p.embed, p.hidden), (p.hidden,), (p.hidden, classes), (classes,)]


def _split(flat: np.ndarray, p: Lm) -> list[np.ndarray]:
    out, at = [], 0
    for shape in _shapes(p):
        n = int(np.prod(shape))
        out.append(flat[at:at + n].reshape(shape))
        at += n
    return out


def initial(p: Lm) -> np.ndarray:
    rng = np.random.default_rng(p.seed)
    parts = [rng.normal(0, 0.3 if i == 0 else 0.2, s) * (i in (0, 1, 3)) for i, s in enumerate(_shapes(p))]
    return np.concatenate([x.ravel() for x in parts]).astype(np.float32)


def word_counts(texts: DataFrame) -> DataFrame:
    """``(h, n)``: hash and count of every word of column ``text`` over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_h, held_n, size = [], [], 0

        def merged():
            h, back = np.unique(np.concatenate(held_h), return_inverse=True)
            return h, np.bincount(back, np.concatenate(held_n), len(h)).astype(np.int64)

        def batch(h, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

        for b in batches:
            for _, data, offsets in T.slices(b.column(0)):
                h, n = np.unique(T.words(T.fold(data), offsets, T.ALNUM).hashes, return_counts=True)
                held_h.append(h), held_n.append(n)
                size += len(h)
                if size > 1 << 20:
                    h, n = merged()
                    if len(h) > 1 << 19:  # bounded memory: hand on what there is
                        yield batch(h, n)
                        held_h, held_n, size = [], [], 0
                    else:
                        held_h, held_n, size = [h], [n], len(h)
        if held_h:
            yield batch(*merged())

    return texts.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, p: Lm) -> dict:
    """Ids, classes and shares of the most frequent words, and the mass of the classes of all others."""
    top = counts.orderBy(F.desc("n"), "h").limit(p.vocabulary).toArrow()
    h = np.asarray(top["h"]).astype(np.int64).view(np.uint64)
    n = np.asarray(top["n"]).astype(np.float64)
    cls = np.arange(len(h))
    if len(h) > p.single:
        rest = np.cumsum(n[p.single:]) - n[p.single:]
        cls[p.single:] = p.single + np.minimum(rest * p.middle / n[p.single:].sum(), p.middle - 1).astype(np.int64)
    mass = np.bincount(cls, n, p.single + p.middle)
    share = np.log(n / mass[cls]) if len(h) else n
    last = (int(top["n"][-1].as_py()), int(top["h"][-1].as_py())) if len(h) else (0, 0)
    out = counts.where((F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("h") > last[1])))
    tail = np.zeros(p.tail)
    for r in out.groupBy(tail_class(F.col("h"), p).alias("c")).agg(F.sum("n").alias("k")).collect():
        tail[r["c"]] = r["k"]
    order = np.argsort(h)
    return {"hash": h[order], "id": order.astype(np.int32), "class": cls[order].astype(np.int32),
            "share": share[order], "tail": tail}


def tail_class(h: Column, p: Lm) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 20), F.lit(p.tail)).cast("int")


def look_up(hashes: np.ndarray, voc: dict, p: Lm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(input id, class, log share of the class) of each word; the share of a word outside the vocabulary is NaN."""
    out, rest = np.arange(len(hashes)), hashes
    ids, cls, share = np.empty(len(hashes), np.int32), np.empty(len(hashes), np.int32), np.empty(len(hashes))
    if len(voc["hash"]):
        at = _places(voc["hash"], hashes)
        ids, cls, share = (voc[k].take(at) for k in ("id", "class", "share"))
        out = np.flatnonzero(voc["hash"].take(at) != hashes)
        rest = hashes[out]
    ids[out] = _U(p.vocabulary) + rest % _U(p.tail_inputs)
    cls[out] = (rest >> _U(20)) % _U(p.tail) + _U(p.single + p.middle)
    share[out] = np.nan
    return ids, cls, share


def _places(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each hash in the sorted ``table``, any place if it is not there: by its first 16 bits, then by steps."""
    first = np.searchsorted(table, np.arange(1 << 16, dtype=np.uint64) << _U(48))
    last = len(table) - 1
    at = np.minimum(first, last).take((hashes >> _U(48)).astype(np.int64))
    for _ in range(int(np.bincount((table >> _U(48)).astype(np.int64)).max()) - 1):
        at += table.take(at) < hashes
        np.minimum(at, last, out=at)
    return at


def contexts(ids: np.ndarray, offsets: np.ndarray, p: Lm) -> Iterator[np.ndarray]:
    """For each neighbour position, the input ids there (the outside id beyond a document's ends)."""
    outside = np.int32(p.vocabulary + p.tail_inputs)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    lo, hi = offsets[:-1][doc], offsets[1:][doc]
    at = np.arange(len(ids))
    for d in [*range(-p.side, 0), *range(1, p.side + 1)]:
        j = at + d
        good = (j >= lo) & (j < hi)
        yield np.where(good, ids[np.clip(j, 0, max(0, len(ids) - 1))], outside) if len(ids) else ids


def padded(ids: np.ndarray, offsets: np.ndarray, p: Lm) -> tuple[np.ndarray, np.ndarray]:
    """The input ids with ``side`` outside ids around every document, and the place of each word: neighbours are shifts."""
    at = np.arange(len(ids)) + np.repeat(np.arange(1, len(offsets)) * p.side, np.diff(offsets))
    out = np.full(len(ids) + len(offsets) * p.side, p.vocabulary + p.tail_inputs, dtype=np.int32)
    out[at] = ids
    return out, at


def _layers(flat: np.ndarray, p: Lm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word vectors, and both layers as (outputs, inputs and one for the bias): a batch is a matrix of word columns."""
    emb, side, bias, out, obias = _split(flat, p)
    return (emb, np.column_stack([side.reshape(-1, p.hidden).T, bias]).astype(np.float32),
            np.column_stack([out.T, obias]).astype(np.float32))


def _forward(v: np.ndarray, first: np.ndarray, second: np.ndarray, p: Lm) -> tuple:
    """Inputs, hidden units and outputs of all places but the first and last ``side`` of ``v``; outputs too large for
    exp are shifted by their maximum."""
    span = v.shape[1] - 2 * p.side
    x = np.empty((first.shape[1], span), dtype=np.float32)
    for j, k in enumerate(_around(p)):
        x[j * p.embed:(j + 1) * p.embed] = v[:, k:k + span]
    x[-1] = 1
    h = np.empty((second.shape[1], span), dtype=np.float32)
    np.tanh(first @ x, out=h[:-1])
    h[-1] = 1
    z = second @ h
    if np.abs(second).sum(axis=1).max() > _SAFE:  # hidden units are at most 1
        z -= z.max(axis=0)
    return x, h, z


def _around(p: Lm) -> list[int]:
    return [*range(p.side), *range(p.side + 1, 2 * p.side + 1)]


def train(rows: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], flat: np.ndarray, p: Lm) -> tuple[np.ndarray, int]:
    """One pass of Adagrad over slices of (ids, classes, offsets); the parameters and the number of words."""
    emb, first, second = _layers(flat, p)
    emb, a_emb = emb.copy(), np.full_like(emb, 1e-3)
    a_first, a_second = np.full_like(first, 1e-3), np.full_like(second, 1e-3)
    narrow = np.uint16 if len(emb) <= 1 << 16 else np.int32  # sorted by radix
    slots, component = np.zeros(len(emb), np.int64), np.arange(p.embed)[:, None]
    seen = 0
    for ids, cls, offsets in rows:
        near, at = padded(ids, offsets, p)
        for i in range(0, len(ids), p.batch):
            y, own = cls[i:i + p.batch], at[i:i + p.batch]
            m = len(y)
            here = near[own[0] - p.side:own[-1] + p.side + 1]
            own = own - own[0]
            v = np.ascontiguousarray(emb.take(here, axis=0).T)
            x, h, z = _forward(v, first, second, p)
            np.exp(z, out=z)
            mass = z.sum(axis=0)
            z[y, own] -= mass[own]
            weight = np.zeros(len(mass), dtype=np.float32)  # places between documents are no words
            weight[own] = 1 / (m * mass[own])
            g_h = (second[:, :-1].T @ z) * ((1 - h[:-1] * h[:-1]) * weight)
            h *= weight
            g_x = first[:, :-1].T @ g_h
            g_v = np.zeros_like(v)
            for j, k in enumerate(_around(p)):
                g_v[:, k:k + g_x.shape[1]] += g_x[j * p.embed:(j + 1) * p.embed]
            met = np.sort(here.astype(narrow), kind="stable")
            touched = met[np.flatnonzero(np.diff(met, prepend=met[0]) != 0)]
            touched = np.concatenate([met[:1], touched]).astype(np.int64)
            slots[touched] = np.arange(len(touched))
            g = np.bincount((slots.take(here) + len(touched) * component).ravel(), g_v.ravel(), p.embed * len(touched))
            g = g.reshape(p.embed, -1).T.astype(np.float32)
            for w, a, d in ((first, a_first, g_h @ x.T), (second, a_second, z @ h.T)):
                a += d * d
                w -= p.rate * d / np.sqrt(a)
            a = a_emb.take(touched, axis=0) + g * g
            a_emb[touched] = a
            emb[touched] -= p.rate * g / np.sqrt(a)
        seen += len(ids)
    return np.concatenate([x.ravel() for x in (
        emb, first[:, :-1].T, first[:, -1], second[:, :-1].T, second[:, -1])]), seen


def fit(docs: DataFrame, p: Lm = Lm(), text_col: str = "text") -> dict:
    """Train on ``docs``: the counts of all words, then rounds of parallel training and averaging.

    ``trained`` is the number of words that a round learned from. A corpus
    with words of which a ``share`` below 1 drew none raises ValueError.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    counts = written(word_counts(texts), "word_counts")
    voc = vocabulary(counts, p)
    inputs = _shapes(p)[0][0]
    rows_in = texts if p.share >= 1 else written(texts.sample(p.share, p.seed), "lm_sample")
    flat, trained = initial(p), 0
    for _ in range(p.rounds):
        shared = spark.sparkContext.broadcast((voc, flat))  # bounded by the vocabulary

        def local(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words, start = shared.value

            def rows(met):
                for b in batches:
                    for _, data, offsets in T.slices(b.column(0)):
                        w = T.words(T.fold(data), offsets, T.ALNUM)
                        if len(w.hashes):
                            ids, cls, _ = look_up(w.hashes, words, p)
                            met += np.bincount(ids, minlength=len(met))
                            met[-1] += p.side * (len(offsets) - 1)  # the outside word
                            yield ids, cls, w.offsets

            one_thread()
            met = np.zeros(inputs, np.int64)
            new, n = train(rows(met), start, p)
            if n:
                wide = np.zeros(-(-len(new) // p.embed) * p.embed)
                wide[:len(new)] = new
                # whole numbers, so that the sums do not depend on their order
                wide = np.rint(wide.reshape(-1, p.embed) * _FIXED).astype(np.int64)
                weight = np.full(len(wide), max(1, n >> 10), np.int64)
                weight[:inputs] = met  # the first rows are the words' vectors
                at = np.flatnonzero(weight)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array(np.full(len(at), n, np.int64)), pa.array(weight[at]),
                     *(pa.array(wide[at, k]) for k in range(p.embed))],
                    names=["row", "n", "w", *(f"v{k}" for k in range(p.embed))])

        schema = "row int, n bigint, w bigint, " + ", ".join(f"v{k} bigint" for k in range(p.embed))
        weighted = [F.sum(F.col(f"v{k}").cast("decimal(20,0)") * F.col("w").cast("decimal(18,0)")).cast("double").alias(f"v{k}")
                    for k in range(p.embed)]
        total = rows_in.mapInArrow(local, schema).groupBy("row").agg(
            F.sum("n").alias("n"), F.sum("w").alias("w"), *weighted).toArrow()
        if total.num_rows:
            row = np.asarray(total["row"])
            trained = int(np.asarray(total["n"])[row.argmax()])  # every task that trained gives the last row
            wide = np.stack([np.asarray(total[f"v{k}"]) for k in range(p.embed)], axis=1)
            # a word's vector that no task met stays as it is
            mean = np.zeros(-(-len(flat) // p.embed) * p.embed)
            mean[:len(flat)] = flat
            mean.reshape(-1, p.embed)[row] = wide / np.asarray(total["w"])[:, None] / _FIXED
            flat = mean[:len(flat)].astype(np.float32)
    if not trained and len(voc["hash"]):
        raise ValueError(f"no document was drawn to train on (share {p.share}); raise the share")
    return {"vocabulary": voc, "counts": counts, "parameters": flat, "p": p, "trained": trained}


def log_likelihood(ids: np.ndarray, cls: np.ndarray, share: np.ndarray, offsets: np.ndarray, tables: tuple, p: Lm
                   ) -> np.ndarray:
    """Log-probability of every word given its neighbours, words outside the vocabulary without their share of the
    class. ``tables``: see ``_layers``."""
    emb, first, second = tables
    total = np.empty(len(ids))
    near, at = padded(ids, offsets, p)
    for i in range(0, len(ids), p.batch):
        own = at[i:i + p.batch]
        here = near[own[0] - p.side:own[-1] + p.side + 1]
        own = own - own[0]
        z = _forward(np.ascontiguousarray(emb.take(here, axis=0).T), first, second, p)[2]
        won = z[cls[i:i + p.batch], own].astype(np.float64)
        total[i:i + p.batch] = won - np.log(np.exp(z, out=z).sum(axis=0))[own]
    return total + np.nan_to_num(share)


def score(docs: DataFrame, model: dict, text_col: str = "text", to_n: str = "n_tokens", to_sum: str = "pll") -> DataFrame:
    """``docs`` with the number of words and the summed log-probability of all of them.

    Null texts and texts without words get 0 and 0.0. Whole texts are scored.
    Equal texts get equal scores. Extra columns pass unchanged; a result name
    that ``docs`` uses gets a suffix. A model of an empty corpus scores too.

    Words outside the vocabulary leave the network's pass by their hash and
    meet the table of all counts in a join: the share of a word seen n times
    is n (1, if never seen) of its class's words and one more. Results return
    to the rows by a 128-bit digest of the text, so texts are not shuffled
    unless the caller keeps them.
    """
    p: Lm = model["p"]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model["vocabulary"], model["parameters"]))

    @F.arrow_udf("struct<n:bigint,s:double,rare:array<bigint>,times:array<bigint>>")
    def pll(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one_thread()
        voc, flat = shared.value
        tables = _layers(flat, p)
        for arr in batches:
            n, s = np.zeros(len(arr), np.int64), np.zeros(len(arr))
            rare, times, ends = [], [], np.zeros(len(arr) + 1, np.int64)
            for row, data, offsets in T.slices(arr):
                w = T.words(T.fold(data), offsets, T.ALNUM)
                count = np.diff(w.offsets)
                n[row:row + len(count)] = count
                full = np.flatnonzero(count)
                if len(full):
                    ids, cls, share = look_up(w.hashes, voc, p)
                    lp = log_likelihood(ids, cls, share, w.offsets, tables, p)
                    s[row + full] = np.add.reduceat(lp, w.offsets[:-1][full])
                    out = np.flatnonzero(np.isnan(share))
                    doc, h = np.searchsorted(w.offsets, out, side="right") - 1, w.hashes[out]
                    order = np.lexsort((h, doc))
                    doc, h = doc[order], h[order]
                    begin = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (h != np.roll(h, 1)))
                    rare.append(h[begin].view(np.int64))
                    times.append(np.diff(begin, append=len(h)))
                    ends[row + 1:row + len(count) + 1] = np.bincount(doc[begin], minlength=len(count))
            ends = pa.array(np.cumsum(ends).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*x, np.zeros(0, np.int64)]))) for x in (rare, times)]
            yield pa.StructArray.from_arrays([pa.array(n), pa.array(s), *lists], ["n", "s", "rare", "times"])

    digest = [F.xxhash64(F.col(f"`{text_col}`")), F.xxhash64(F.lit(p.seed), F.col(f"`{text_col}`"))]
    key = [free_name(docs, k) for k in ("text_key", "text_key2")]
    one = docs.select(*[d.alias(k) for d, k in zip(digest, key)], pll.asNondeterministic()(F.col(f"`{text_col}`")).alias("x"))
    one = written(one.select(*key, F.monotonically_increasing_id().alias("row"), "x.*"), "likelihoods")
    mass = F.array(*[F.lit(float(m)) for m in model["vocabulary"]["tail"]])
    words = one.select("row", F.inline(F.arrays_zip(F.col("rare").alias("h"), F.col("times").alias("k"))).alias("h", "k"))
    share = F.log(F.coalesce("n", F.lit(1)) / (F.get(mass, tail_class(F.col("h"), p)) + 1))
    # whole billionths, so that the sum does not depend on its order
    rare = words.join(model["counts"], "h", "left").groupBy("row").agg(
        (F.sum(F.rint(share * F.col("k") * 1e9).cast("bigint")) / 1e9).alias("r"))
    total = one.join(rare, "row", "left").groupBy(*key).agg(
        F.first("n").alias("n"), F.first(F.col("s") + F.coalesce("r", F.lit(0.0))).alias("s"))
    tmp_n, tmp_s = free_name(docs, "likelihood_n"), free_name(docs, "likelihood_s")
    total = total.select(*key, F.col("n").alias(tmp_n), F.col("s").alias(tmp_s))
    keyed = docs
    for d, k in zip(digest, key):
        keyed = keyed.withColumn(k, d)
    return keyed.join(total, key, "left").select(
        *columns(docs), F.col(tmp_n).alias(free_name(docs, to_n)), F.col(tmp_s).alias(free_name(docs, to_sum)))
