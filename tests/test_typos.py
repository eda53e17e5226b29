"""Typo repair against a comparison of every value with every allowed one."""

import random

import pytest

from lakemart.operators import typos


def _levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _edits(a, b):
    swapped = any(a[:i] + a[i + 1] + a[i] + a[i + 2:] == b for i in range(len(a) - 1))
    return 1 if swapped and a != b else _levenshtein(a, b)


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("k", [1, 2, 3])
def test_all_pairs(spark, k):
    rnd = random.Random(k)
    allowed = sorted({"".join(rnd.choice("ABC") for _ in range(rnd.randrange(1, 8))) for _ in range(25)})
    raw = sorted({"".join(rnd.choice("ABCé") for _ in range(rnd.randrange(1, 10))) for _ in range(150)})
    got = {r["value"]: r for r in typos.typo_matches(_frame(spark, raw), _frame(spark, allowed), k).collect()}
    assert set(got) == set(raw)
    for v in raw:
        near = {t: _edits(v.upper(), t) for t in allowed}
        least = min(near.values())
        best = sorted(t for t, n in near.items() if n == least)
        r = got[v]
        if least > k:
            assert (r.status, r.fixed, r.n_edits, r.candidates) == ("unknown", None, None, None)
        elif least == 0:
            assert (r.status, r.fixed, r.n_edits) == ("exact", v.upper(), 0)
        elif len(best) == 1:
            assert (r.status, r.fixed, r.n_edits) == ("repaired", best[0], least)
        else:
            assert (r.status, r.fixed, r.candidates) == ("ambiguous", None, "|".join(best))


def test_rows(spark):
    df = spark.createDataFrame([(1, "Londn"), (2, " PARIS "), (3, None), (4, ""), (5, "Zzz"), (6, "Pariss"), (7, "Lodnon"), (8, "x" * 5000), (9, "Londn")],
                               "id int, city string")
    out = {r.id: (r.city, r.status) for r in typos.repair_values(df, "city", _frame(spark, ["London", "Paris", None, " "])).collect()}
    assert out == {1: ("London", "repaired"), 2: ("Paris", "exact"), 3: (None, "missing"), 4: ("", "missing"), 5: ("Zzz", "unknown"),
                   6: ("Paris", "repaired"), 7: ("London", "repaired"), 8: ("x" * 5000, "unknown"), 9: ("London", "repaired")}


def test_nothing_allowed(spark):
    df = spark.createDataFrame([(1, "a")], "id int, city string")
    assert [r.status for r in typos.repair_values(df, "city", _frame(spark, [])).collect()] == ["unknown"]
    assert typos.typo_report(df.limit(0), "city", _frame(spark, ["a"])).count() == 0
