"""Benchmark passages in documents, found by CGK embedding and bit sampling.

Method: the CGK random walk reads a window of words and writes one symbol a
step; after each symbol a random bit of (step, symbol) says whether to move
on to the next word. Windows at small edit distance give outputs at small
Hamming distance, so a key made of a few sampled output positions is often
equal for both. Several walks with several keys each reach the target recall.
A candidate whose window shares half of its words with the item is then
verified by the exact edit distance between the item's words and the document
around it.

Windows: an item of n words is indexed at every offset in windows of w words;
a document is cut into windows of w words at every s-th word. With
``w + s - 1 <= n`` each occurrence holds a whole document window, so only one
in s positions of a document needs a walk. The pair (w, s) is (3, 1) doubled
while an occurrence still holds two document windows, up to (12, 4): walks
drift apart as edits add up, so a longer item has more windows, not longer ones.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm import text as T
from lakemart.llm.store import free_name

_U = np.uint64
_PAD = np.uint32(0)
_WIDEST = 12


@dataclass(frozen=True)
class Decontam:
    """Parameters.

    A document holds an item if some run of its words is within
    ``edit_pct`` percent of the item's words (rounded down) in edit distance
    over words. ``walks`` CGK walks with ``keys`` keys of ``samples``
    positions each are tried. A colliding window needs ``shared_pct`` percent
    of its words among the item's: of the windows of an occurrence some have
    no more than the item's share of edits. ``block_bytes``: items are
    broadcast in blocks whose index takes about this many bytes; more items
    mean more blocks.
    """

    edit_pct: int = 20
    walks: int = 3
    keys: int = 12
    samples: int = 5
    shared_pct: int = 50
    block_bytes: int = 128 << 20


def _size_class(n: int) -> tuple[int, int]:
    """(window, stride) for an item of n words."""
    w, s = 3, 1
    while 2 * w <= _WIDEST and 2 * w + 4 * s - 1 <= n:
        w, s = 2 * w, 2 * s
    return min(w, n), s


def _walk_plan(p: Decontam, w: int, walk: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Multipliers of a walk's steps, and the sampled steps of each key.

    Late steps mostly lie behind the window's last word, where all windows
    agree, and edits add up; samples come from the first 5/4 w steps.
    """
    rng = np.random.default_rng([w, walk, 20240229])
    steps = 2 * w
    early = max(min(p.samples, steps), 5 * w // 4)
    picks = [np.sort(rng.choice(early, size=min(p.samples, early), replace=False)) for _ in range(p.keys)]
    return rng.integers(0, 1 << 32, size=steps, dtype=np.uint32) | np.uint32(1), picks


def embed_keys(tokens: np.ndarray, starts: np.ndarray, w: int, walk: int, p: Decontam) -> np.ndarray:
    """Sampled-bit keys (one row a key) of the windows ``tokens[starts:starts + w]``.

    ``tokens`` are 32-bit word hashes; each document is followed by at least
    ``w`` padding symbols, which also stand for what lies behind a window.
    """
    factors, picks = _walk_plan(p, w, walk)
    used_by = defaultdict(list)
    for k, steps in enumerate(picks):
        for j in steps:
            used_by[int(j)].append(k)
    at = starts.astype(np.int32)
    end = at + np.int32(w)
    pad_at = np.int32(len(tokens) - 1)
    keys = np.empty((p.keys, len(starts)), dtype=np.uint64)
    keys[:] = T.mix(np.arange(p.keys, dtype=np.uint64) + _U((walk + 1) << 32 | w << 8))[:, None]
    for j in range(max(used_by) + 1):
        sym = tokens[at if j < w else np.where(at < end, at, pad_at)]
        for k in used_by.get(j, ()):
            row = keys[k]
            row ^= sym
            row *= _U(0x9FB21C651E98DF25)
            row ^= row >> _U(29)
        sym *= factors[j]
        sym >>= np.uint32(31)
        at += sym.view(np.int32)
    return keys


def _tokens(w: T.Words, gap: int) -> np.ndarray:
    """32-bit symbols with ``gap`` padding symbols behind each document."""
    count = np.diff(w.offsets)
    out = np.full(len(w.hashes) + gap * len(count) + 1, _PAD, dtype=np.uint32)
    at = np.arange(len(w.hashes)) + np.repeat(np.arange(len(count)) * gap, count)
    out[at] = (w.hashes >> _U(32)).astype(np.uint32) | np.uint32(1)  # never the padding symbol
    return out


_GROUPS = 1024


def _group(hashes: np.ndarray) -> np.ndarray:
    return (hashes & _U(_GROUPS - 1)).astype(np.int16)


def build_index(texts: list[str | None], p: Decontam) -> dict:
    """Keys of all item windows, with a bitmap to pass over most document windows."""
    items, found, at, classes = [], [], [], set()
    for i, t in enumerate(texts):
        arr = pa.array([t or ""], type=pa.large_string())
        w = next(((T.words(T.fold(d), o, T.ALNUM)) for _, d, o in T.slices(arr)))
        items.append(w.hashes.tolist())
        n = len(w.hashes)
        if not n:
            continue
        size, stride = _size_class(n)
        classes.add((size, stride))
        starts = np.arange(0, n - size + 1)
        for walk in range(p.walks):
            k = embed_keys(_tokens(w, size), starts, size, walk, p)
            found.append(k.reshape(-1))
            at.append(np.stack([np.full(k.size, i), np.tile(starts, p.keys)], axis=1))
    keys = np.concatenate(found) if found else np.zeros(0, np.uint64)
    at = np.concatenate(at) if at else np.zeros((0, 2), np.int64)
    order = np.argsort(keys, kind="stable")
    # 16 to 32 bits a key
    bits = max(16, int(16 * max(1, len(keys))).bit_length())
    slot = keys >> _U(64 - bits)
    seen = np.zeros(1 << (bits - 3), dtype=np.uint8)
    np.bitwise_or.at(seen, slot >> _U(3), np.uint8(1) << (slot & _U(7)).astype(np.uint8))
    holds = np.zeros((len(items), _GROUPS), dtype=bool)
    for i, x in enumerate(items):
        holds[i, _group(np.array(x, dtype=np.uint64))] = True
    return {"items": items, "sizes": np.array([len(x) for x in items], dtype=np.int64), "holds": holds,
            "keys": keys[order], "at": at[order].astype(np.int32), "bits": bits, "seen": seen,
            "classes": sorted(classes), "p": p}


def best_distance(pattern: list[int], region: list[int]) -> int:
    """Smallest edit distance between ``pattern`` and any run of ``region`` (bit-parallel columns)."""
    m = len(pattern)
    if not m:
        return 0
    where: dict[int, int] = {}
    for i, x in enumerate(pattern):
        where[x] = where.get(x, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for x in region:
        eq = where.get(x, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        rise = (down | ~(diag | up)) & full
        fall = up & diag
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise = rise << 1 & full
        up = (fall << 1 | ~(diag | rise)) & full
        down = diag & rise
        if score < best:
            best = score
    return best


def scan(arr: pa.Array, index: dict) -> list[list[tuple[int, int]]]:
    """Per text, (item number, distance) of the items that it holds."""
    p: Decontam = index["p"]
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(arr))]
    for row, data, offsets in T.slices(arr):
        w = T.words(T.fold(data), offsets, T.ALNUM)
        gap = max((size for size, _ in index["classes"]), default=1)
        tokens = _tokens(w, gap)
        group = np.append(_group(w.hashes), np.zeros(_WIDEST, np.int16))
        count = np.diff(w.offsets)
        cand = []
        for size, stride in index["classes"]:
            per = -(-count // stride)  # a window at every stride-th word; behind the last word it is padded
            doc = np.repeat(np.arange(len(count)), per)
            first = np.cumsum(per) - per
            starts = w.offsets[:-1][doc] + (np.arange(len(doc)) - first[doc]) * stride
            for walk in range(p.walks):
                keys = embed_keys(tokens, starts + doc * gap, size, walk, p)
                slot = keys.reshape(-1) >> _U(64 - index["bits"])
                hit = np.flatnonzero(index["seen"][slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8) & np.uint8(1))
                k = keys.reshape(-1)[hit]
                lo = np.searchsorted(index["keys"], k, side="left")
                n = np.searchsorted(index["keys"], k, side="right") - lo
                pick = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                window = np.repeat(hit % len(starts), n)
                item, at = index["at"][pick].T
                shared = np.zeros(len(item), dtype=np.int16)
                for j in range(size):
                    shared += index["holds"][item, group[starts[window] + j]]
                near = 100 * shared >= p.shared_pct * size
                window, item, at = window[near], item[near], at[near]
                cand.append(np.unique((doc[window] * len(index["items"]) + item << 32) + starts[window] - at))
        if cand:
            both = np.unique(np.concatenate(cand))
            start = (both + (1 << 31) & (1 << 32) - 1) - (1 << 31)
            doc, item = np.divmod(both - start >> 32, len(index["items"]))
            _verify(np.stack([doc, item, start], axis=1), w, index, out, row)
    return out


def _verify(cand: np.ndarray, w: T.Words, index: dict, out: list, row: int) -> None:
    """Exact check of (document, item, expected start) rows; keeps the least distance of each item."""
    doc, item, start = cand.T
    n = index["sizes"][item]
    allowed = n * index["p"].edit_pct // 100
    lo = np.maximum(w.offsets[doc], start - allowed)
    hi = np.minimum(w.offsets[doc + 1], start + n + allowed)
    # within k edits, at least n - k words around must be words of the item
    group = np.append(_group(w.hashes), np.int16(0))
    common = np.zeros(len(cand), dtype=np.int64)
    for j in range(int((hi - lo).max(initial=0))):
        common += index["holds"][item, group[np.minimum(lo + j, len(group) - 1)]] & (lo + j < hi)
    best: dict[tuple[int, int], int] = {}
    for c in np.flatnonzero(common >= n - allowed).tolist():
        key = int(doc[c]), int(item[c])
        most = best.get(key, int(allowed[c]) + 1)
        if most == 0:
            continue
        pattern, region = index["items"][key[1]], w.hashes[lo[c]:hi[c]].tolist()
        if len(set(pattern) - set(region)) > allowed[c]:
            continue
        best[key] = min(most, best_distance(pattern, region))
    for (d, i), distance in sorted(best.items()):
        if distance <= index["sizes"][i] * index["p"].edit_pct // 100:
            out[row + d].append((i, distance))


HITS = "array<struct<item_id:bigint,n_words:int,distance:int>>"


def _scanner(spark, ids: list[int | None], texts: list[str | None], p: Decontam):
    shared = spark.sparkContext.broadcast((ids, build_index(texts, p)))

    @F.arrow_udf(HITS)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, index = shared.value
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_words", pa.int32()), ("distance", pa.int32())]))
        for arr in batches:
            yield pa.array([[{"item_id": names[i], "n_words": len(index["items"][i]), "distance": d} for i, d in x]
                            for x in scan(arr, index)], type=kind)

    return hits.asNondeterministic()  # so that the optimiser never evaluates it twice


def with_hits(docs: DataFrame, benchmark: DataFrame, to: str, p: Decontam = Decontam(), text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with column ``to``: array of (item_id, n_words, distance) that the text holds.

    Null or empty texts hold nothing; items without words are held by none;
    items that repeat a text are all reported; an empty benchmark gives empty
    arrays. The items travel in blocks of bounded size, each block scanning
    every document.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("bigint").alias("id"), F.col(item_text).alias("t"))
    # a key takes 16 bytes and its bits, a word starts about one window
    size = items.agg(F.coalesce(F.sum(F.regexp_count("t", F.lit(r"[\p{L}\p{N}]+"))), F.lit(0)).alias("words"), F.count(F.lit(1)).alias("n")).first()
    blocks = min(size["words"] * p.walks * p.keys * 20 // p.block_bytes, max(0, size["n"] - 1)) + 1
    part = [F.array().cast(HITS)]
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("t", "id"), F.lit(blocks)) == b).orderBy("id", "t").collect()
        if rows:
            part.append(_scanner(spark, [r["id"] for r in rows], [r["t"] for r in rows], p)(F.col(text_col)))
    return docs.withColumn(to, F.concat(*part) if len(part) > 2 else part[-1])


def contaminated(docs: DataFrame, benchmark: DataFrame, p: Decontam = Decontam(), id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col, item_id, n_words, distance``: a row per document and item that it holds."""
    found = with_hits(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), benchmark, "hits", p)
    return found.select("id", F.explode("hits").alias("h")).select(
        F.col("id").alias(id_col), "h.item_id", "h.n_words", "h.distance")


def decontaminate(docs: DataFrame, benchmark: DataFrame, p: Decontam = Decontam(),
                  text_col: str = "text") -> DataFrame:
    """The documents that hold no item, columns unchanged."""
    to = free_name(docs, "hits")
    return with_hits(docs, benchmark, to, p, text_col).where(F.size(to) == 0).drop(to)
