import zlib

import numpy as np
import pyarrow as pa
import pytest

from lakemart.llm import langid as L
from lakemart.llm import queries as Q

SF = "/root/testdata/sf0.01"
P = L.LangId(train_docs=200, sequences=300, epochs=3)
ONE = "the house and the river were there when others gathered together".split()
TWO = "der hund lief durch die strasse und schrie nach seinem grossen bruder".split()


def text(words, seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(words[i] for i in rng.integers(len(words), size=n))


@pytest.fixture(scope="module")
def model():
    return L.train([(text(w, s, 60), l) for s in range(20) for w, l in ((ONE, "en"), (TWO, "de"))], P)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    k, lengths = 3, [1, 4, 2, 5]
    score, trans, start = rng.normal(size=(sum(lengths), k)), rng.normal(size=(k, k)), rng.normal(size=k)
    new = np.zeros(len(score), dtype=bool)
    new[np.cumsum([0, *lengths[:-1]])] = True
    got = L.marginals(score, new, trans, start)
    at = 0
    for n in lengths:
        want = np.zeros((n, k))
        for path in np.ndindex(*[k] * n):
            s = start[path[0]] + sum(score[at + i, c] for i, c in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:]))
            want[range(n), path] += np.exp(s)
        assert np.allclose(got[at:at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_switched_text_is_labelled_word_by_word(model):
    data = (text(ONE, 99, 30) + " " + text(TWO, 98, 30)).encode()
    for _, d, o in L.T.slices(pa.array([data.decode()])):
        w = L.T.words(L.T.fold(d), o, L.LETTERS)
        s = L.emissions(model["weights"], *L.word_features(w.data, w.starts, w.ends, P.buckets))
        p = L.marginals(s, np.arange(len(s)) == 0, model["trans"], model["start"])
    best = [model["labels"][i] for i in p.argmax(axis=1)]
    assert best == ["en"] * 30 + ["de"] * 30
    lang, score = L.label_texts(pa.array([data.decode()]), model, P)
    assert 0.45 < score[0] < 0.6


def test_odd_texts(model):
    long = text(TWO, 7, 50_000)
    lang, score = L.label_texts(pa.array([None, "", "123 - !?", "…", long, "HUND", long]), model, P)
    assert lang == ["und"] * 4 + ["de"] * 3 and list(score[:4]) == [0.0] * 4 and score[4] == pytest.approx(score[6])
    assert L.label_texts(pa.array([], type=pa.string()), model, P)[0] == []


def test_held_out_accuracy(spark):
    rows = Q.op6_language_id(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.95


def test_odd_rows(odd_docs, no_docs, make_docs):
    out = L.identify(odd_docs, P)
    assert out.columns == [*odd_docs.columns, "lang_pred", "score_1"]
    got = {r.doc_id: r.lang_pred for r in out.collect() if r.doc_id is not None}
    assert got[3] == got[4] == got[5] == got[6] == "und" and got[1] == got[10] == "en"
    kept = L.keep_known(odd_docs, P)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 2, 7, 9, 10]
    assert L.identify(no_docs, P).count() == 0
    unlabelled = make_docs([(1, "some words", None)])
    assert [r.lang_pred for r in L.identify(unlabelled, P).collect()] == ["und"]
