import random

import pyarrow as pa
import pytest

from lakemart.llm import decontam as D
from tests.llm.conftest import WORDS, prose


def words(t):
    return (t or "").split()


def edit(a, b):
    """Smallest edit distance of a to any run of b, by the full table."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


ITEMS = [prose(900 + i, n) for i, n in enumerate((15, 18, 22, 31, 40, 63, 8, 4, 1))]


def test_distance_is_exact():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
        b = [rng.randrange(4) for _ in range(rng.randrange(0, 20))]
        assert D.best_distance(a, b) == edit(a, b)


def test_exact_passages_are_always_found():
    index = D.build_index(ITEMS, D.Decontam())
    for i, item in enumerate(ITEMS):
        for lead in range(0, 40, 3):
            text = " ".join([prose(lead + 1, lead), item, prose(lead + 2, 5)])
            assert (i, 0) in D.scan(pa.array([text]), index)[0]


def test_recall_and_exactness_with_edits():
    rng = random.Random(5)
    index = D.build_index(ITEMS[:6], D.Decontam())
    found = 0
    for k in range(300):
        i = k % 6
        w = ITEMS[i].split()
        for _ in range(len(w) // 10):
            at = rng.randrange(len(w))
            w[at:at + rng.choice((0, 1, 1))] = rng.choice(([], [rng.choice(WORDS)]))
        text = words(prose(k, 50)) + w + words(prose(k + 1, 30))
        hits = dict(D.scan(pa.array([" ".join(text)]), index)[0])
        for item, d in hits.items():
            assert edit(ITEMS[item].split(), text) <= d <= len(ITEMS[item].split()) // 5
        found += i in hits
    assert found >= 290


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(ITEMS[:6])] + [(70, ITEMS[0]), (71, None), (72, ""), (None, None)],
                                 "item_id bigint, text string")


def test_odd_rows(odd_docs, make_docs, benchmark):
    leaks = make_docs([(20, prose(20, 30) + " " + ITEMS[3].upper() + ". " + prose(21, 10)), (21, ITEMS[0].replace(" ", ",\n"))])
    docs = odd_docs.unionByName(leaks)
    hits = sorted((r.doc_id, r.item_id, r.n_words, r.distance) for r in D.contaminated(docs, benchmark).collect())
    assert hits == [(20, 3, 31, 0), (21, 0, 15, 0), (21, 70, 15, 0)]
    clean = D.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == odd_docs.count()


def test_blocks_change_nothing(make_docs, benchmark):
    docs = make_docs([(i, prose(i, 20) + " " + ITEMS[i % 6]) for i in range(12)])
    rows = lambda p: sorted(map(tuple, D.contaminated(docs, benchmark, p).collect()))
    assert rows(D.Decontam(block_bytes=150)) == rows(D.Decontam()) != []


def test_no_rows(no_docs, odd_docs, benchmark):
    assert D.contaminated(no_docs, benchmark).count() == 0
    assert D.decontaminate(odd_docs, benchmark.limit(0)).count() == odd_docs.count()


@pytest.mark.parametrize("kind", ["mixed", "delete"])
@pytest.mark.parametrize("n", [15, 18, 31, 63, 127, 255, 300])
def test_recall_at_the_full_edit_share_for_all_lengths(n, kind):
    """n // 5 edits at different words of an item of n words."""
    rng = random.Random(n)
    items = [prose(7000 + n * 7 + i, n) for i in range(4)]
    texts = []
    for k in range(60):
        w = [[x] for x in items[k % 4].split()]
        for j, at in enumerate(rng.sample(range(n), n // 5)):
            new = f"new{rng.randrange(10**6)}"
            w[at] = [[], [new], [*w[at], new]][0 if kind == "delete" else j % 3]
        texts.append(" ".join(words(prose(k + 1, 30 + k % 17)) + [x for y in w for x in y] + words(prose(k + 2, 30))))
    hits = D.scan(pa.array(texts), D.build_index(items, D.Decontam()))
    assert sum(k % 4 in dict(h) for k, h in enumerate(hits)) >= 59


def test_a_block_of_the_index_stays_within_its_bytes():
    """About as many words as fit one block: the arrays that travel take no more than half as much again."""
    p = D.Decontam(block_bytes=8 << 20)
    per_item = 40 * p.walks * p.keys * 20
    index = D.build_index([prose(i, 40) for i in range(p.block_bytes // per_item)], p)
    assert sum(index[k].nbytes for k in ("keys", "at", "seen", "holds")) < 1.5 * p.block_bytes


def test_windows_that_share_few_words_are_no_candidates(monkeypatch):
    """Collisions of common words alone do not reach the check of the surroundings."""
    got = []
    monkeypatch.setattr(D, "_verify", lambda cand, w, index, out, row: got.append(len(cand)))
    common = " ".join(random.Random(3).choices(["the", "of", "and", "to", "in", *WORDS], weights=[9] * 5 + [1] * len(WORDS), k=20_000))
    D.scan(pa.array([common]), D.build_index([prose(7, 40) + " the of and to in the of", ITEMS[4]], D.Decontam()))
    assert sum(got) < 2000
