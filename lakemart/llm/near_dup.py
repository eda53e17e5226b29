"""Near-duplicate groups by MinHash bands, odd sketches and exact checks.

Method: every text becomes the set of its word shingles. MinHash samples of
the set give (a) band keys, whose equality makes two texts candidates, and
(b) an odd sketch: a bitmap whose bit ``hash(i, minhash_i) mod n`` is flipped
once for each sample i. Two sketches differ in about
``n/2 * (1 - exp(-4k(1-J)/n))`` bits, so the population count of their XOR
estimates a high similarity J precisely. A second bitmap folds the whole set
in the same way; for sets that are not large against it, it gives the size of
the symmetric difference almost exactly. Candidates whose estimates lie
clearly below the threshold go; the others are confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm import text as T
from lakemart.llm.components import connected_components
from lakemart.llm.store import discard, keep_ids, written

_U = np.uint64


@dataclass(frozen=True)
class NearDup:
    """Parameters.

    ``shingle`` words make a shingle; pairs with Jaccard similarity of
    ``threshold`` (a whole percentage) or more are linked. With 32 bands of 5
    a pair at 85 % shares no band with probability 5e-9, at 80 % with 3e-6.
    ``slack`` is how far an odd-sketch estimate may lie below the threshold
    (its standard deviation is about 0.036 with 160 samples, so five of them); the parity
    bitmap of the whole set has ``parity_bits`` and five standard deviations
    of slack. Set sizes are tested too.
    ``chain_rounds``: passes that compare neighbours in a random order of
    each bucket, before the remaining pairs across components are compared
    one by one. Buckets are ordered in parts of about ``chain`` members.
    """

    shingle: int = 5
    threshold_pct: int = 80
    bands: int = 32
    rows: int = 5
    bits: int = 512
    parity_bits: int = 1024
    slack: float = 0.18
    chain_rounds: int = 4
    chain: int = 2000


def shingle_sets(arr: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes per text (empty without words)."""
    for _, data, offsets in T.slices(arr):
        w = T.words(T.LOWER[data], offsets, T.NON_SPACE)
        h = w.hashes
        grams = T.mix(h * _U(3))
        for k in range(1, n):
            grams[:len(h) - k] = T.mix(grams[:len(h) - k] * _U(0x9E3779B97F4A7C15) + h[k:]) if len(h) > k else grams[:0]
        for i in range(len(offsets) - 1):
            lo, hi = w.offsets[i], w.offsets[i + 1]
            if hi - lo >= n:
                yield np.unique(grams[lo:hi - n + 1])
            elif hi > lo:
                whole = np.array([hi - lo], dtype=np.uint64)
                for x in h[lo:hi]:
                    whole = T.mix(whole * _U(0x9E3779B97F4A7C15) + x)
                yield whole
            else:
                yield h[:0]


def _minhashes(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    out = np.full(len(mul), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(s), 2048):
        part = s[i:i + 2048]
        np.minimum(out, (part[None, :] * mul[:, None] + add[:, None]).min(axis=1), out=out)
    return out


SIGNATURE = "struct<n:bigint,c1:bigint,c2:bigint,bands:array<bigint>,sketch:array<bigint>,parity:array<bigint>>"


def _bitmap(bit: np.ndarray, bits: int) -> np.ndarray:
    """Bit i is set if i occurs an odd number of times."""
    return np.packbits((np.bincount(bit.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view(np.uint64)


def signature(p: NearDup):
    """Arrow UDF: set size, 128-bit set digest, band keys, odd sketch and parity bitmap of a text."""
    k = p.bands * p.rows
    seeds = T.mix(np.arange(1, 2 * k + 1, dtype=np.uint64))
    mul, add = seeds[:k] | _U(1), seeds[k:]
    sample_no = T.mix(np.arange(1, k + 1, dtype=np.uint64) << _U(20))
    band_no = T.mix(np.arange(1, p.bands + 1, dtype=np.uint64) << _U(40))

    @F.arrow_udf(SIGNATURE)
    def sig(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            m = len(arr)
            size = np.zeros(m, np.int64)
            digest = np.zeros((2, m), np.uint64)
            bands = np.zeros((m, p.bands), np.uint64)
            sketch = np.zeros((m, p.bits // 64), np.uint64)
            parity = np.zeros((m, p.parity_bits // 64), np.uint64)
            for i, s in enumerate(shingle_sets(arr, p.shingle)):
                size[i] = len(s)
                if not len(s):
                    continue
                digest[0, i] = np.bitwise_xor.reduce(T.mix(s)) + _U(len(s))
                digest[1, i] = np.add.reduce(T.mix(s ^ _U(0x5851F42D4C957F2D)))
                mh = _minhashes(s, mul, add)
                key = band_no
                for r in range(p.rows):
                    key = T.mix(key + mh[r::p.rows])
                bands[i] = key
                sketch[i] = _bitmap(T.mix(mh ^ sample_no) % _U(p.bits), p.bits)
                parity[i] = _bitmap(T.mix(s + _U(1)) % _U(p.parity_bits), p.parity_bits)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)),
                                              pa.array(x.reshape(-1).view(np.int64))) for x in (bands, sketch, parity)]
            yield pa.StructArray.from_arrays(
                [pa.array(size), pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)), *lists],
                names=["n", "c1", "c2", "bands", "sketch", "parity"])

    return sig


def similar(p: NearDup):
    """Arrow UDF: do two texts' full shingle sets reach the threshold?"""

    @F.arrow_udf("boolean")
    def check(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(shingle_sets(a, p.shingle), shingle_sets(b, p.shingle)):
            common = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - common
            out.append(bool(union) and 100 * common >= p.threshold_pct * union)
        return pa.array(out, type=pa.bool_())

    return check


def _odd_bits(a: Column, b: Column, bits: int) -> Column:
    """Population count of two bitmaps' XOR."""
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(bits // 64)), F.lit(0))


def sketch_similarity(a: Column, b: Column, p: NearDup) -> Column:
    """Jaccard estimate from the population count of two odd sketches' XOR."""
    odd = _odd_bits(a, b, p.bits)
    left = F.greatest(1 - 2 * odd / F.lit(float(p.bits)), F.lit(1e-9))
    return 1 + F.log(left) * (p.bits / (4.0 * p.bands * p.rows))


def _max_odd_bits(p: NearDup) -> int:
    """The XOR population count beyond which the estimate is below threshold - slack."""
    j = p.threshold_pct / 100 - p.slack
    return math.ceil(p.bits / 2 * (1 - math.exp(-4 * p.bands * p.rows * (1 - j) / p.bits)))


def _close(a: str, b: str, p: NearDup) -> Column:
    """Could columns ``a`` and ``b`` (n, sketch, parity) reach the threshold, by set sizes and both bitmaps?"""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    bits = float(p.parity_bits)
    # the largest symmetric difference at the threshold, and the odd bits that so many elements leave
    most = (na + nb) * ((100 - p.threshold_pct) / (100 + p.threshold_pct))
    mean = (1 - F.exp(most * (-2 / bits))) * (bits / 2)
    var = (1 - F.exp(most * (-4 / bits))) * (bits / 4) - most * F.exp(most * (-4 / bits))
    # few pairs reach this test; as a lambda it keeps the join's generated code small enough to be compiled
    apart = F.aggregate(F.zip_with(f"{a}.parity", f"{b}.parity", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda acc, x: acc + x)
    return ((100 * F.least(na, nb) >= p.threshold_pct * F.greatest(na, nb))
            & (_odd_bits(F.col(f"{a}.sketch"), F.col(f"{b}.sketch"), p.bits) <= _max_odd_bits(p))
            & (apart <= mean + 5 * F.sqrt(var) + 1))


def near_duplicates(docs: DataFrame, p: NearDup = NearDup(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id reachable over links of the threshold
    or more; ``kept`` marks the row that carries it. Texts that are null or
    without words have no shingles and link with nothing. Rows with a null id
    take no part: component null, kept true. Rows that repeat an id count as
    one document (all of them kept or none). Ties cannot occur: only sizes
    and ids are compared. Other columns, whatever their names, are ignored.

    Plan: one Arrow pass makes signatures. Equal sets collapse to their
    smallest id first, so a group of copies costs one row. A pass orders each
    bucket at random (in parts) and compares neighbours that are in different
    components, so it costs one comparison a member and leaves few components
    among many near copies. What is left is compared pair by pair across
    components, with the sketch tests inside the join; no pair is skipped.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sig = written(src.select("id", signature(p)("text").alias("s")).select("id", "s.*"), "signatures")
    sets = sig.where("id is not null and n > 0")
    reps = written(sets.groupBy("c1", "c2").agg(F.min(F.struct("id", "n", "bands", "sketch", "parity")).alias("m")).select("m.*"),
                   "representatives")
    member = reps.select("id", F.explode("bands").alias("key"))
    shared = member.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = written(member.join(shared, "key").select("key", "id", F.ceil(F.col("n") / p.chain).alias("parts")), "buckets")
    active = buckets.select("id").distinct()
    sketches = written(reps.join(active, "id", "left_semi").select("id", F.struct("n", "sketch", "parity", "bands").alias("s")),
                       "sketches")

    comp = written(active.withColumn("comp", F.col("id")), "components")
    failed = None
    step = 0
    while True:
        last = step >= p.chain_rounds
        if last:
            rows = buckets.join(comp, "id")
            mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
            rows = written(rows.join(mixed.select("key"), "key").join(sketches, "id"), "mixed")
            other = rows.select("key", F.col("id").alias("id2"), F.col("comp").alias("comp2"), F.col("s").alias("s2"))
            # a pair that shares several buckets counts in the first of them
            first = F.array_intersect("s.bands", "s2.bands")[0] == F.col("key")
            cand = (rows.join(other, "key").where((F.col("id") < F.col("id2")) & (F.col("comp") != F.col("comp2"))
                                                  & _close("s", "s2", p) & first)
                    .select(F.col("id").alias("a"), F.col("id2").alias("b"), F.col("comp").alias("ca"),
                            F.col("comp2").alias("cb")).distinct())
        else:
            # every pass takes its share of the bands
            some = buckets.where(F.pmod(F.xxhash64("key"), F.lit(p.chain_rounds)) == step).join(comp, "id")
            line = Window.partitionBy("key", F.pmod(F.xxhash64("id", F.lit(step)), F.col("parts"))).orderBy(
                F.xxhash64("id", "key"), "id")
            pairs = some.select(F.lag("id").over(line).alias("x"), F.lag("comp").over(line).alias("cx"),
                                F.col("id").alias("y"), F.col("comp").alias("cy")).where("cx <> cy")
            pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
                                 F.when(F.col("x") < F.col("y"), F.col("cx")).otherwise(F.col("cy")).alias("ca"),
                                 F.when(F.col("x") < F.col("y"), F.col("cy")).otherwise(F.col("cx")).alias("cb")).distinct()
            cand = (pairs.join(sketches.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a")
                    .join(sketches.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
                    .where(_close("sa", "sb", p)).select("a", "b", "ca", "cb"))
        if failed is not None:
            cand = cand.join(failed, ["a", "b"], "left_anti")
        cand = written(cand, "candidates")
        if last:
            discard(rows)
        linked = False
        if cand.limit(1).count():
            # only the texts of candidates are shuffled
            need = written(cand.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "candidate_ids")
            texts = keep_ids(src, "id", need)
            done = written(cand.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
                           .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
                           .select("a", "b", "ca", "cb", similar(p)("ta", "tb").alias("link")), "checked")
            discard(need)
            linked = done.where("link").limit(1).count() > 0
            no = done.where("not link").select("a", "b")
            failed = no if failed is None else failed.unionByName(no)
        if linked:
            roots = connected_components(done.where("link").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            before, comp = comp, written(comp.join(roots.withColumnRenamed("node", "comp"), "comp", "left")
                                         .select("id", F.coalesce("component", "comp").alias("comp")), "components")
            discard(before)
        discard(cand)
        if last:
            break
        step += 1

    discard(reps, buckets, sketches)
    ids = sets.groupBy("c1", "c2").agg(F.min("id").alias("rep"))
    roots = ids.join(comp.select(F.col("id").alias("rep"), "comp"), "rep", "left").select(
        "c1", "c2", F.coalesce("comp", "rep").alias("comp"))
    linked = sets.join(roots, ["c1", "c2"]).select("id", "n", "comp")
    alone = sig.where("id is null or n = 0").select("id", "n", F.col("id").alias("comp"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
        F.coalesce(F.col("id") == F.col("comp"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, p: NearDup = NearDup(), id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group, columns unchanged.

    The smallest id of a group stays. Documents without words and rows with a
    null id stay. Rows that repeat an id fall together to one row.
    """
    found = written(near_duplicates(docs, p, id_col, text_col), "near_duplicates")
    out = keep_ids(docs, id_col, found.where("not kept").select(id_col).distinct(), "left_anti")
    total = found.where(F.col(id_col).isNotNull()).agg(
        F.count("*").alias("rows"), F.count_distinct(id_col).alias("ids")).first()
    if total["rows"] != total["ids"]:
        out = out.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(out.where(F.col(id_col).isNull()))
    return out
