"""URL filter: rules first, then a ratio of two character language models.

URLs that a rule accepts or rejects train one variable-order Markov model
each. A character's probability blends all context lengths: the count of the
longer context, smoothed towards the estimate of the shorter one. Every other
URL is judged by its length-normalised log-likelihood difference against a
threshold calibrated on labelled URLs that the models had not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakemart.llm import text as T
from lakemart.llm.store import written

_U = np.uint64
_CHUNK = 12  # 4,096 rows of a task are scored together
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlModel:
    """Parameters.

    ``order``: the longest context in bytes. N-grams are counted by their
    64-bit hash, all of them; ``slots`` (a power of two) folds the hashes into
    so many, 0 leaves them whole. ``strength`` is how
    many observations the shorter context's estimate counts for. One in
    ``folds`` labelled URLs calibrates the threshold, in steps of ``1/bins``.
    """

    order: int = 5
    slots: int = 0
    strength: float = 2.0
    folds: int = 5
    bins: int = 200


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, nulls if none does. The list of rules is short."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the last that fits wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name).otherwise(name)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def _grams(arr: pa.Array, p: UrlModel) -> Iterator[tuple[slice, np.ndarray, list, list]]:
    """Per slice: (rows, text number of each byte, slots of contexts, slots of n-grams) for all orders."""
    for row, data, offsets in T.slices(arr):
        n = np.diff(offsets)
        at = np.arange(len(data)) + np.repeat(np.arange(1, len(n) + 1), n)
        text = np.full(len(data) + len(n), 0x01, dtype=np.uint8)  # a start mark before each text
        text[at] = data
        doc = np.repeat(np.arange(len(n)), n)
        begin = (offsets[:-1] + np.arange(len(n)))[doc]
        contexts, grams = [], []
        for k in range(p.order + 1):
            lo = np.maximum(at - k, begin)
            salt = _U((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            # a context that would reach beyond the start mark is the one up to the mark
            for hashes, of in ((T.span_hash(text, lo, at) + salt, contexts), (T.span_hash(text, lo, at + 1) ^ salt, grams)):
                hashes = T.mix(hashes)
                of.append((hashes & _U(p.slots - 1) if p.slots else hashes).view(np.int64))
        yield slice(row, row + len(n)), doc, contexts, grams


def _count(labelled: DataFrame, p: UrlModel) -> DataFrame:
    """``(fold, side, kind, slot, n)`` over all labelled URLs: ``side`` 1 accepted, 0 rejected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fold, side = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("fold", "side"))
            for rows, doc, contexts, grams in _grams(b.column("url"), p):
                for key in sorted({*zip(fold[rows].tolist(), side[rows].tolist())}):
                    of = ((fold[rows] == key[0]) & (side[rows] == key[1]))[doc]
                    for kind, codes in enumerate((contexts, grams)):
                        slot, n = np.unique(np.concatenate([c[of] for c in codes]), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(slot), x, np.int64)) for x in (*key, kind)] + [pa.array(slot), pa.array(n)],
                            names=["fold", "side", "kind", "slot", "n"])

    return labelled.select("url", "fold", "side").mapInArrow(
        count, "fold bigint, side bigint, kind bigint, slot bigint, n bigint"
    ).groupBy("fold", "side", "kind", "slot").agg(F.sum("n").alias("n"))


class Counts:
    """``counts[side, kind, slots]`` from rows ``kind, slot, n0, n1``; 0 for n-grams without a row."""

    def __init__(self, rows: pa.Table):
        kind, slot, *n = (rows[c].to_numpy() for c in ("kind", "slot", "n0", "n1"))
        self.of = []
        for k in (0, 1):
            order = np.flatnonzero(kind == k)
            order = order[np.argsort(slot[order], kind="stable")]
            self.of.append((slot[order], [x[order].astype(np.float64) for x in n]))

    def __getitem__(self, key: tuple[int, int, np.ndarray]) -> np.ndarray:
        side, kind, slots = key
        known, n = self.of[kind]
        if not len(known):
            return np.zeros(len(slots))
        at = np.minimum(np.searchsorted(known, slots), len(known) - 1)
        return np.where(known[at] == slots, n[side][at], 0.0)


def log_ratio(arr: pa.Array, counts: np.ndarray | Counts, p: UrlModel) -> np.ndarray:
    """(log P(accepted) - log P(rejected)) per byte. ``counts[side, kind, slot]``; 0.0 for an empty URL."""
    out = np.zeros(len(arr))
    for rows, doc, contexts, grams in _grams(arr, p):
        diff = np.zeros(len(doc))
        for side, sign in ((1, 1.0), (0, -1.0)):
            prob = np.full(len(doc), 1 / 256)
            for c, g in zip(contexts, grams):
                prob = (counts[side, 1, g] + p.strength * prob) / (counts[side, 0, c] + p.strength)
            diff += sign * np.log(prob)
        texts = rows.stop - rows.start
        out[rows] = np.bincount(doc, diff, texts) / np.maximum(np.bincount(doc, minlength=texts), 1)
    return out


def _with_ratio(rows: DataFrame, counts: DataFrame, p: UrlModel) -> DataFrame:
    """``rows`` (with ``chunk`` and ``url``) and their ``ratio``.

    Each chunk of rows asks for its n-grams' counts by a join and is scored
    with those alone, so no task holds the whole count table. The join is a
    sort-merge join at every size: Spark takes what the chunks ask for to be
    no more rows than URLs, a small part of what it is, and would broadcast it.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            chunk = b.column("chunk").to_numpy()
            for rows, doc, contexts, grams in _grams(b.column("url"), p):
                for c in np.unique(chunk[rows]):
                    of = (chunk[rows] == c)[doc]
                    for kind, codes in enumerate((contexts, grams)):
                        slot = np.unique(np.concatenate([x[of] for x in codes]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(slot), x, np.int64)) for x in (c, kind)] + [pa.array(slot)],
                            names=["chunk", "kind", "slot"])

    def ratio(urls: pa.Table, found: pa.Table) -> pa.Table:
        return urls.append_column("ratio", pa.array(log_ratio(urls["url"], Counts(found), p)))

    found = rows.select("chunk", "url").mapInArrow(ask, "chunk bigint, kind bigint, slot bigint").join(
        counts.hint("merge"), ["kind", "slot"]).select("chunk", "kind", "slot", "n0", "n1")
    return rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        ratio, StructType([*rows.schema.fields, StructField("ratio", DoubleType())]))


def _by_side(table: DataFrame) -> DataFrame:
    """``kind, slot, n0, n1``: the counts among rejected and accepted URLs."""
    return table.groupBy("kind", "slot").agg(
        *(F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0)).alias(f"n{side}") for side in (0, 1)))


def fit(labelled: DataFrame, p: UrlModel = UrlModel()) -> tuple[DataFrame, float] | None:
    """(count table, threshold) from ``labelled(chunk, url, side)``; None unless both sides occur.

    All labelled URLs count. The threshold is the one with the best mean of
    both sides' hit rates on the calibration fold, scored by the models
    without that fold; of equally good ones the nearest to 0.
    """
    rows = labelled.withColumn("fold", (F.pmod(F.xxhash64("url"), F.lit(p.folds)) == 0).cast("bigint"))
    table = written(_count(rows, p), "url_counts")
    if {r["side"] for r in table.select("side").distinct().collect()} != {0, 1}:
        return None
    calibration = _with_ratio(rows.where("fold = 1"), _by_side(table.where("fold = 0")), p)
    edge = 10 * p.bins
    found = calibration.groupBy(
        F.greatest(F.lit(-edge), F.least(F.lit(edge), F.floor(F.col("ratio") * p.bins))).alias("bin"), "side"
    ).agg(F.count("*").alias("n")).collect()
    hist = np.zeros((2, 2 * edge + 1))
    for r in found:
        hist[r["side"], r["bin"] + edge] = r["n"]
    # a URL passes at threshold b when its bin is b or more
    passed = hist[:, ::-1].cumsum(axis=1)[:, ::-1]
    total = np.maximum(hist.sum(axis=1, keepdims=True), 1)
    rate = passed[1] / total[1] + 1 - passed[0] / total[0]
    best = np.flatnonzero(rate >= rate.max() - 1e-12) - edge
    return _by_side(table), float(best[np.argmin(np.abs(best))]) / p.bins


def judge(pages: DataFrame, rules: list[Rule], p: UrlModel = UrlModel(), id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row.

    A URL that is null or has no ``://`` has empty host and path and fits no
    rule. Rules see host and path; the language models read the whole URL,
    with scheme, query and fragment. Null (or no byte at all) has ratio 0. Without URLs of both verdicts to learn from, what no rule fits is
    allowed. Repeated URLs all count in training. Other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"), F.col(url_col).alias("url"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = written(rows.withColumn("rule", name).withColumn("ruled", verdict)
                   .withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), _CHUNK)), "urls")
    model = fit(rows.where("ruled is not null").select(
        "chunk", "url", (F.col("ruled") == ALLOW).cast("bigint").alias("side")), p)
    out = [F.col("id").alias(id_col), "host", "path", "rule"]
    if model is None:
        return rows.select(*out, F.coalesce("ruled", F.lit(ALLOW)).alias("verdict"))
    counts, threshold = model
    rest = _with_ratio(rows.where("ruled is null").drop("ruled"), counts, p)
    judged = F.when(F.col("ratio") >= threshold, ALLOW).otherwise(BLOCK)
    return rows.where("ruled is not null").select(*out, F.col("ruled").alias("verdict")).unionAll(
        rest.select(*out, judged.alias("verdict")))
