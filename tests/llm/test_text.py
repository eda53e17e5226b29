import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import text as T


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé \n\t.x", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_match_regex(texts, limit):
    found = [[] for _ in texts]
    for row, data, offsets in T.slices(pa.array(texts, type=pa.string()), limit):
        w = T.words(T.LOWER[data], offsets, T.NON_SPACE)
        for i in range(len(offsets) - 1):
            for j in range(w.offsets[i], w.offsets[i + 1]):
                found[row + i].append(bytes(w.data[w.starts[j]:w.ends[j]]).decode())
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", (t or "").replace("B", "b")) for t in texts]


def test_hash_depends_on_content_only():
    data = np.frombuffer(b"abcabcxabc", dtype=np.uint8)
    h = T.span_hash(data, np.array([0, 3, 7, 0, 1]), np.array([3, 6, 10, 4, 4]))
    assert h[0] == h[1] == h[2] and len(set(h.tolist())) == 3


def test_fold_latin_capitals():
    data = np.frombuffer("ÀÉÞ×ß AZ".encode(), dtype=np.uint8)
    assert bytes(T.fold(data)).decode() == "àéþ×ß az"


def test_words_do_not_depend_on_the_block(monkeypatch):
    rng = np.random.default_rng(6)
    docs = ["".join(rng.choice(list("ab  é.")) for _ in range(n)) for n in (0, 40, 1, 700, 0, 3, 90, 0)]
    data, offsets = next((d, o) for _, d, o in T.slices(pa.array(docs)))
    whole = T.words(data, offsets, T.ALNUM)
    for block in (1, 50, 128):
        monkeypatch.setattr(T, "BLOCK_BYTES", block)
        got = T.words(data, offsets, T.ALNUM)
        for name in ("hashes", "offsets", "starts", "ends"):
            assert np.array_equal(getattr(got, name), getattr(whole, name))
