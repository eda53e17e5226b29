import numpy as np
import pyarrow as pa
import pytest

from lakemart.llm import lm as M
from tests.llm.conftest import prose

P = M.Lm(vocabulary=40, tail_inputs=8, single=5, middle=6, tail=3, share=1.0, batch=64)


@pytest.fixture(scope="module")
def grammar(make_docs):
    """Words that follow one another in a fixed cycle, and rare ones."""
    cycle = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(cycle[(i + j) % 30] for j in range(300)) + f" rare{i} " + cycle[0]) for i in range(30)]
    return make_docs(rows)


@pytest.fixture(scope="module")
def model(grammar):
    return M.fit(grammar, P)


def naive(text, model):
    """The same sum, one word at a time."""
    p = model["p"]
    emb, side, bias, out, obias = M._split(model["parameters"].astype(np.float64), p)
    counts = {r.h: r.n for r in model["counts"].collect()}
    for _, d, o in M.T.slices(pa.array([text])):
        hashes = M.T.words(M.T.fold(d), o, M.T.ALNUM).hashes
        ids, cls, share = M.look_up(hashes, model["vocabulary"], p)
    for t in np.flatnonzero(np.isnan(share)):
        n = counts.get(int(hashes[t].astype(np.int64)), 1)
        share[t] = np.log(n / (model["vocabulary"]["tail"][cls[t] - p.single - p.middle] + 1))
    total = 0.0
    for t in range(len(ids)):
        h = bias.copy()
        for k, d in enumerate([*range(-p.side, 0), *range(1, p.side + 1)]):
            h = h + emb[ids[t + d] if 0 <= t + d < len(ids) else p.vocabulary + p.tail_inputs] @ side[k]
        z = np.tanh(h) @ out + obias
        total += z[cls[t]] - np.log(np.exp(z - z.max()).sum()) - z.max() + share[t]
    return total


def test_matches_word_by_word_sum(grammar, model, make_docs):
    texts = ["w1 w2 w3 w4 w5 unseen w7", "w9", "w3 w3 w3. W3!", prose(1, 40)]
    docs = make_docs([(i, t) for i, t in enumerate(texts)])
    got = {r.doc_id: (r.n_tokens, r.pll) for r in M.score(docs, model).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == len(t.split()) and got[i][1] == pytest.approx(naive(t, model), rel=1e-4)


def test_learns_order_from_both_sides(model, make_docs):
    cycle = [f"w{i}" for i in range(30)]
    shuffled = np.random.default_rng(2).permutation(cycle * 4).tolist()
    rows = {r.doc_id: r.pll / r.n_tokens for r in M.score(make_docs([(1, " ".join(cycle * 4)), (2, " ".join(shuffled))]), model).collect()}
    assert rows[1] > rows[2] + 1


def test_probabilities_sum_to_one(model):
    voc, p = model["vocabulary"], model["p"]
    shares = np.bincount(voc["class"], np.exp(voc["share"]), p.single + p.middle)
    assert np.allclose(shares[shares > 0], 1)


def test_words_outside_the_vocabulary_keep_their_counts(make_docs):
    """A rare word that occurs more often is likelier, by its exact share of its class."""
    rows = [(i, " ".join(f"w{j}" for j in range(45)) + (" seldom" if i < 2 else " oft")) for i in range(30)]
    p = M.Lm(vocabulary=20, tail_inputs=1, single=5, middle=6, tail=1, batch=64)
    model = M.fit(make_docs(rows), p)
    got = {r.doc_id: r.pll for r in M.score(make_docs([(1, "seldom"), (2, "oft"), (3, "never")]), model).collect()}
    assert got[2] - got[1] == pytest.approx(np.log(28 / 2)) and got[1] - got[3] == pytest.approx(np.log(2))
    assert model["vocabulary"]["tail"].sum() == sum(r.n for r in model["counts"].collect()) - 20 * 30


def test_average_leaves_out_tasks_that_never_met_a_word(spark, make_docs):
    """Tasks that did not see a word do not pull its vector back to where it began."""
    rows = [(i, " ".join(["p", "q"] * 60) if i == 0 else " ".join(["r", "s"] * 60)) for i in range(8)]
    p = M.Lm(vocabulary=10, tail_inputs=2, single=2, middle=2, tail=1, batch=16, rounds=1)
    docs = make_docs(rows).repartition(8, "doc_id")
    together, alone = M.fit(docs, p), M.fit(make_docs(rows[:1]), p)
    vec = lambda m, w: M._split(m["parameters"], p)[0][m["vocabulary"]["id"][m["vocabulary"]["hash"] == h(w)][0]]
    h = lambda w: next(M.T.words(d, o, M.T.ALNUM).hashes[0] for _, d, o in M.T.slices(pa.array([w])))
    begin = lambda m, w: M._split(M.initial(p), p)[0][m["vocabulary"]["id"][m["vocabulary"]["hash"] == h(w)][0]]
    moved = np.abs(vec(together, "p") - begin(together, "p")).sum()
    assert moved > 0.5 * np.abs(vec(alone, "p") - begin(alone, "p")).sum()


def test_counts_cover_all_rows(spark, grammar):
    assert M.word_counts(grammar.select("text")).agg({"n": "sum"}).first()[0] == 30 * 302


def test_odd_rows(odd_docs, no_docs):
    model = M.fit(odd_docs, P)
    out = M.score(odd_docs, model)
    assert out.columns == [*odd_docs.columns, "n_tokens", "pll"]
    rows = out.collect()
    assert {r.doc_id: (r.n_tokens, r.pll) for r in rows if r.doc_id in (3, 4, 5, 6)} == {i: (0, 0.0) for i in (3, 4, 5, 6)}
    assert len({r.pll for r in rows if r.doc_id in (1, 2)}) == 1
    assert all(np.isfinite(r.pll) for r in rows) and {r.n_tokens for r in rows if r.doc_id == 7} == {60_000}
    empty = M.fit(no_docs, P)
    assert M.score(no_docs, empty).count() == 0
    assert all(np.isfinite(r.pll) for r in M.score(odd_docs, empty).collect())


def test_every_document_trains_the_production_network(grammar, make_docs, odd_docs):
    assert M.Lm().share == 1.0
    model = M.fit(grammar, M.Lm(vocabulary=40, tail_inputs=8, single=5, middle=6, tail=3, batch=64))
    assert model["trained"] == 30 * 302
    # a single document is never left out, nor is a word behind it
    one = M.fit(make_docs([(1, "a b c a b c d")]), M.Lm())
    assert one["trained"] == 7 and not np.array_equal(one["parameters"], M.initial(M.Lm()))
    assert M.fit(odd_docs, M.Lm())["trained"] == 3 * 80 + 60_000 + 30 + 40 + 1


def test_one_pass_matches_plain_gradients():
    """Adagrad over documents of all lengths, with one gradient entry per word and neighbour."""
    rng, p = np.random.default_rng(4), P
    offsets = np.array([0, 0, 1, 40, 40, 43, 200, 200])
    ids = rng.integers(0, p.vocabulary + p.tail_inputs, 200).astype(np.int32)
    cls = rng.integers(0, p.single + p.middle + p.tail, 200).astype(np.int32)
    got, seen = M.train(iter([(ids, cls, offsets)]), M.initial(p), p)
    want = M.initial(p).astype(np.float64)
    acc = np.full_like(want, 1e-3)
    ctx = np.stack(list(M.contexts(ids, offsets, p)), axis=1)
    for i in range(0, 200, p.batch):
        grad = np.zeros_like(want)
        emb, side, bias, out, obias = M._split(want, p)
        g_emb, g_side, g_bias, g_out, g_obias = M._split(grad, p)
        m = len(cls[i:i + p.batch])
        for c, y in zip(ctx[i:i + p.batch], cls[i:i + p.batch]):
            h = np.tanh(sum(emb[c[k]] @ side[k] for k in range(2 * p.side)) + bias)
            z = h @ out + obias
            z = np.exp(z - z.max())
            z /= z.sum()
            z[y] -= 1
            g_h = (out @ z) * (1 - h * h) / m
            g_out += np.outer(h, z) / m
            g_obias += z / m
            g_bias += g_h
            for k in range(2 * p.side):
                g_side[k] += np.outer(emb[c[k]], g_h)
                g_emb[c[k]] += side[k] @ g_h
        acc += grad * grad
        want -= p.rate * grad / np.sqrt(acc)
    assert seen == 200 and np.allclose(got, want, atol=1e-3)


def test_rare_words_are_counted_in_their_document_not_by_a_shuffle(make_docs, monkeypatch):
    """The pass over the texts hands on each rare word of a document once, with its count."""
    rows = [(i, " ".join(f"w{j}" for j in range(45)) + (" seldom" if i < 2 else " oft")) for i in range(9)]
    p = M.Lm(vocabulary=20, tail_inputs=1, single=5, middle=6, tail=1, batch=64)
    model = M.fit(make_docs(rows), p)
    seen = {}

    def kept(df, name, real=M.written):
        seen[name] = real(df, name)
        return seen[name]

    monkeypatch.setattr(M, "written", kept)
    docs = make_docs([(1, "seldom oft seldom seldom"), (2, None), (3, "oft"), (4, "oft never oft")])
    got = {r.doc_id: r.pll for r in M.score(docs, model).collect()}
    assert sorted(sorted(r.times) for r in seen["likelihoods"].collect()) == [[], [1], [1, 2], [1, 3]]
    for i, t in ((1, "seldom oft seldom seldom"), (4, "oft never oft")):
        assert got[i] == pytest.approx(naive(t, model), rel=1e-4)


def test_large_outputs_do_not_overflow(grammar, model):
    """Parameters whose outputs are too large for exp still give finite training steps and scores."""
    p = model["p"]
    flat = M.initial(p) * 400
    ids = np.random.default_rng(3).integers(0, 40, 300).astype(np.int32)
    cls, offsets = ids % (p.single + p.middle), np.array([0, 100, 101, 300])
    new, seen = M.train(iter([(ids, cls, offsets)]), flat, p)
    assert seen == 300 and np.isfinite(new).all()
    assert np.isfinite(M.log_likelihood(ids, cls, np.zeros(300), offsets, M._layers(flat, p), p)).all()


def test_look_up_finds_every_word_of_the_vocabulary():
    rng = np.random.default_rng(4)
    h = np.sort(np.concatenate([rng.integers(0, 1 << 63, 500, dtype=np.uint64), np.arange(9, dtype=np.uint64) + np.uint64(77 << 48)]))
    n = len(h)
    voc = {"hash": h, "id": rng.permutation(n).astype(np.int32), "class": rng.integers(0, 9, n).astype(np.int32),
           "share": rng.normal(size=n)}
    p = M.Lm(vocabulary=n)
    for some in (h, h + np.uint64(1000), np.array([0, (1 << 64) - 1], np.uint64), h[:0]):
        at = {int(x): i for i, x in enumerate(h)}
        ids, cls, share = M.look_up(some, voc, p)
        for k, x in enumerate(some.tolist()):
            i = at.get(x)
            assert ids[k] == (p.vocabulary + x % p.tail_inputs if i is None else voc["id"][i])
            assert cls[k] == ((x >> 20) % p.tail + p.single + p.middle if i is None else voc["class"][i])
            assert np.isnan(share[k]) if i is None else share[k] == voc["share"][i]
