"""Language of code-switched text by a linear-chain conditional random field.

Every word gets a label distribution by forward-backward over the whole text;
a text's language is the one with the most expected words. Emission scores are
sums of learned weights of hashed features: affixes (1-4 bytes at either
end), character n-grams (2 and 3 bytes, word ends marked) and the word itself
(the learned lexicon). Label transitions are learned too, from training
sequences that switch language between spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm import text as T
from lakemart.llm.store import columns, free_name

_U = np.uint64
LETTERS = T.byte_class(lambda b: b >= 0x80 or chr(b).isalpha())
UNKNOWN = "und"


@dataclass(frozen=True)
class LangId:
    """Parameters.

    Training uses a bounded sample: at most ``train_docs`` labelled rows in
    all, shared evenly by the languages, cut into ``sequences`` sequences of
    ``length`` words drawn from anywhere in these texts. ``buckets`` bounds
    the feature table (a power of two); ``epochs``, ``rate``, ``decay`` and
    ``batch`` steer Adagrad; ``switch`` is the chance that a training span
    ends after a word.
    """

    train_docs: int = 1600
    sequences: int = 1800
    length: int = 48
    buckets: int = 1 << 18
    epochs: int = 5
    batch: int = 100
    rate: float = 0.25
    decay: float = 1e-5
    switch: float = 0.05
    seed: int = 11


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, offset of each word's features) of the words at these spans."""
    n = ends - starts
    # copy the words into one array, each between two end marks
    base = np.cumsum(n + 2) - (n + 2)
    text = np.full(int((n + 2).sum()), 0x01, dtype=np.uint8)
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    text[np.repeat(base + 1, n) + inner] = data[np.repeat(starts, n) + inner]
    word, lo, hi, kind = [], [], [], []

    def add(w, a, b, k):
        word.append(w), lo.append(a), hi.append(b), kind.append(np.full(len(w), k, dtype=np.uint64))

    every = np.arange(len(n))
    add(every, base, base + n + 2, 1)  # lexicon
    for k in (1, 2, 3, 4):  # affixes
        w = every[n >= k]
        add(w, base[w], base[w] + 1 + k, 2)
        add(w, base[w] + n[w] + 1 - k, base[w] + n[w] + 2, 3)
    for k in (2, 3):  # n-grams anywhere
        per = np.maximum(n - k + 1, 0)
        w = np.repeat(every, per)
        a = base[w] + 1 + np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        add(w, a, a + k, 4)
    word, lo, hi = np.concatenate(word), np.concatenate(lo), np.concatenate(hi)
    h = T.span_hash(text, lo, hi) + np.concatenate(kind) * _U(0x9E3779B97F4A7C15)
    feature = (T.mix(h) & _U(buckets - 1)).astype(np.int32)
    order = np.argsort(word, kind="stable")
    return feature[order], np.searchsorted(word[order], every)


def emissions(weights: np.ndarray, feature: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log scores (words x labels)."""
    if not len(first):
        return np.zeros((0, weights.shape[1]), dtype=np.float64)
    return np.add.reduceat(weights[feature], first, axis=0).astype(np.float64)


def marginals(score: np.ndarray, new: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Label probabilities of every word, for many texts one behind the other.

    ``score``: log emissions; ``new``: True at the first word of each text;
    ``trans``: log transitions; ``start``: log scores of a first label. The
    sequence is cut into chunks whose transfer matrices are multiplied first,
    so the exact recursion runs over all chunks at once; a new text makes a
    step independent of the one before.
    """
    n, k = score.shape
    if not n:
        return score
    steps = max(1, int(np.sqrt(n)))
    chunks = -(-n // steps)
    e = np.ones((chunks * steps, k))
    e[:n] = np.exp(score - score.max(axis=1, keepdims=True))
    fresh = np.zeros(chunks * steps, dtype=bool)
    fresh[:n] = new
    e = e.reshape(chunks, steps, k)
    fresh = fresh.reshape(chunks, steps)
    a = np.exp(trans - trans.max())
    pi = np.exp(start - start.max())
    first = [np.flatnonzero(x) for x in fresh.T]

    def step(v, t):  # rows of v (chunks x m x labels) one word on
        out = (v.reshape(-1, k) @ a).reshape(v.shape)
        if len(first[t]):
            out[first[t]] = v[first[t]].sum(axis=2, keepdims=True) * pi
        out *= e[:, t, None, :]
        if t % 8 == 0 or t == steps - 1:  # against underflow
            out /= out.sum(axis=(1, 2), keepdims=True)
        return out

    product = np.broadcast_to(np.eye(k), (chunks, k, k)).copy()
    for t in range(steps):
        product = step(product, t)
    into = np.empty((chunks, 1, k))
    out_of = np.empty((chunks, k))
    v = np.full((1, k), 1.0 / k)
    for c in range(chunks):
        into[c] = v
        v = v @ product[c]
        v /= v.sum()
    v = np.full(k, 1.0 / k)
    for c in range(chunks - 1, -1, -1):
        out_of[c] = v
        v = product[c] @ v
        v /= v.sum()
    alpha = np.empty((chunks, steps, k))
    v = into
    for t in range(steps):
        v = step(v, t)
        alpha[:, t] = v[:, 0]
    v = out_of
    for t in range(steps - 1, -1, -1):
        alpha[:, t] *= v
        ev = e[:, t] * v
        v = ev @ a.T
        if len(first[t]):
            v[first[t]] = (ev[first[t]] @ pi)[:, None]
        if t % 8 == 0:
            v /= v.sum(axis=1, keepdims=True)
    p = alpha.reshape(-1, k)[:n]
    return p / p.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str, str]], p: LangId = LangId()) -> dict | None:
    """Fit the model on (text, language) pairs; None without a usable pair."""
    labels = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(p.seed)
    pool: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for t, lang in samples:
        arr = pa.array([t], type=pa.large_string())
        for _, data, offsets in T.slices(arr):
            w = T.words(T.fold(data), offsets, LETTERS)
            if len(w.starts):
                pool.setdefault(labels.index(lang), []).append((w.data, w.starts, w.ends))
    if not pool:
        return None
    k, known = len(labels), sorted(pool)
    # spans of words, one language each, filled into sequences of equal length
    text, starts, ends, y = [], [], [], []
    base = filled = 0
    while filled < p.sequences * p.length:
        lang = known[rng.integers(len(known))]
        data, s, e = pool[lang][rng.integers(len(pool[lang]))]
        room = p.length - filled % p.length
        n = min(int(rng.geometric(p.switch)), room, len(s))
        i = int(rng.integers(len(s) - n + 1))
        lo, hi = s[i], e[i + n - 1]
        text.append(data[lo:hi])
        starts.append(s[i:i + n] - lo + base)
        ends.append(e[i:i + n] - lo + base)
        y.append(np.full(n, lang))
        base += hi - lo
        filled += n
    y = np.concatenate(y).reshape(p.sequences, p.length)
    feature, first = word_features(np.concatenate(text), np.concatenate(starts), np.concatenate(ends), p.buckets)
    last = np.append(first[1:], len(feature))
    weights = np.zeros((p.buckets, k), dtype=np.float32)
    trans, start = np.zeros((k, k)), np.zeros(k)
    sq = [np.full_like(x, 1e-6) for x in (weights, trans, start)]
    for epoch in range(p.epochs):
        order = rng.permutation(p.sequences)
        for at in range(0, p.sequences, p.batch):
            rows = order[at:at + p.batch]
            words = (rows[:, None] * p.length + np.arange(p.length)).ravel()
            n = last[words] - first[words]
            feats = feature[np.repeat(first[words], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            score = emissions(weights, feats, np.cumsum(n) - n).reshape(len(rows), p.length, k)
            gold = y[rows]
            gamma, pairs = _expect(score, trans, start)
            diff = -gamma
            np.put_along_axis(diff, gold[:, :, None], np.take_along_axis(diff, gold[:, :, None], 2) + 1, 2)
            g_w = np.stack([np.bincount(feats, np.repeat(diff[:, :, c].ravel(), n), p.buckets) for c in range(k)], 1)
            g_t = np.bincount((gold[:, :-1] * k + gold[:, 1:]).ravel(), minlength=k * k).reshape(k, k) - pairs
            g_s = diff[:, 0].sum(axis=0)
            for x, g, q in zip((weights, trans, start), (g_w, g_t, g_s), sq):
                g = g - p.decay * x * len(words)
                q += (g * g).astype(q.dtype)
                x += (p.rate * g / np.sqrt(q)).astype(x.dtype)
    return {"labels": labels, "weights": weights, "trans": trans, "start": start}


def _expect(score: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities and summed label-pair expectations of sequences of equal length."""
    b, n, k = score.shape
    e = np.exp(score - score.max(axis=2, keepdims=True))
    a = np.exp(trans)
    alpha, beta = np.empty((b, n, k)), np.ones((b, n, k))
    v = e[:, 0] * np.exp(start)
    alpha[:, 0] = v / v.sum(axis=1, keepdims=True)
    for t in range(1, n):
        v = (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = v / v.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(n - 2, -1, -1):
        ev = e[:, t + 1] * beta[:, t + 1]
        v = ev @ a.T
        beta[:, t] = v / v.sum(axis=1, keepdims=True)
        xi = alpha[:, t, :, None] * a * ev[:, None, :]
        pairs += (xi / xi.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    gamma = alpha * beta
    return gamma / gamma.sum(axis=2, keepdims=True), pairs


def label_texts(arr: pa.Array, model: dict | None, p: LangId) -> tuple[list[str], np.ndarray]:
    """Language and score (its mean probability over the words) of each text."""
    lang, conf = np.full(len(arr), UNKNOWN, dtype=object), np.zeros(len(arr))
    if model is None or not len(arr):
        return lang.tolist(), conf
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    has_letter = pc.fill_null(pc.match_substring_regex(arr.cast(pa.large_string()), r"\pL"), False).to_numpy(False)
    for row, data, offsets in T.slices(arr):
        w = T.words(T.fold(data), offsets, LETTERS)
        if not len(w.hashes):
            continue
        _, at, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        score = emissions(model["weights"], *word_features(w.data, w.starts[at], w.ends[at], p.buckets))[back]
        count = np.diff(w.offsets)
        full = np.flatnonzero(count)
        new = np.zeros(len(w.hashes), dtype=bool)
        new[w.offsets[:-1][full]] = True
        total = np.add.reduceat(marginals(score, new, model["trans"], model["start"]), w.offsets[:-1][full], axis=0)
        best = total.argmax(axis=1)
        for i, b, s in zip(full.tolist(), best.tolist(), (total[np.arange(len(best)), best] / count[full]).tolist()):
            if has_letter[row + i]:
                lang[row + i], conf[row + i] = model["labels"][b], min(1.0, round(s, 8))
    return lang.tolist(), conf


def held_out(id_col: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, divisible by 5 (false for a null id)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def sample_labelled(docs: DataFrame, p: LangId, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """A bounded sample of training rows, about as many for each language."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where(
        F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("t").isNotNull() & F.col("l").isNotNull())
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    each = max(1, p.train_docs // len(counts))
    turn = F.pmod(F.xxhash64(F.lit(p.seed), "id"), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for l, n in counts.items()
                           for x in (l, min(1 << 30, int((1 << 30) * (each + 4 * each ** 0.5) / n)))])
    got: dict[str, list] = {}
    for r in rows.withColumn("turn", turn).where(F.col("turn") < share[F.col("l")]).collect():
        got.setdefault(r["l"], []).append((r["turn"], r["id"], r["t"]))
    return [(t, l) for l in sorted(got) for _, _, t in sorted(got[l])[:each]]


def identify(docs: DataFrame, p: LangId = LangId(), id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", to_lang: str = "lang_pred", to_score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1).

    The model learns from the texts and labels of rows that are not held out;
    a prediction reads the text only. Null texts and texts without a letter
    get ``und`` and 0.0, as does every text when no row is labelled. Of
    languages with equally many expected words the first by name wins. Extra
    columns pass unchanged; a result name that ``docs`` uses gets a suffix.
    A null id is never held out and never trains.
    """
    model = train(sample_labelled(docs, p, id_col, text_col, lang_col), p)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets x languages

    @F.arrow_udf("struct<l:string,s:double>")
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            lang, score = label_texts(arr, shared.value, p)
            yield pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["l", "s"])

    tmp = free_name(docs, "language")
    out = docs.withColumn(tmp, label.asNondeterministic()(F.col(text_col)))
    return out.select(*columns(docs), F.col(f"{tmp}.l").alias(free_name(docs, to_lang)),
                      F.col(f"{tmp}.s").alias(free_name(docs, to_score)))


def keep_known(docs: DataFrame, p: LangId = LangId(), min_score: float = 0.5, id_col: str = "doc_id",
               text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents with a recognised language, columns unchanged; ``und`` and doubtful ones go."""
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = identify(docs, p, id_col, text_col, lang_col, lang, score)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).drop(lang, score)
