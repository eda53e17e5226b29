import pytest

WORDS = ("amber basil cedar delta ember fjord grove haven ivory jolly karma lemon maple noble ocean pearl quilt raven "
         "solar tiger umber vivid waltz xenon yacht zebra anvil birch coral drift eagle flint gourd hazel inlet joust").split()


def prose(seed: int, n: int) -> str:
    """n words in a repeatable pseudo-random order."""
    x, out = seed * 2654435761 % 2**32 + 1, []
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % 2**32
        out.append(WORDS[(x >> 16) % len(WORDS)] + str((x >> 8) % 7))
    return " ".join(out)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, n string, score string, `a.b` string"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Rows of (doc_id, text[, lang[, source]]) with extra columns whose names clash with inner ones."""
        full = [(*r, *["en", "src0"][len(r) - 2:]) for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or ""), "id", "n", "score", "a.b") for r in full], SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, repeated rows and ties."""
    return make_docs([
        (1, prose(1, 80)), (2, prose(1, 80)), (2, prose(1, 80)), (3, None), (4, ""), (5, " \n\t "), (6, "?!"),
        (7, prose(7, 60_000)), (None, prose(8, 30)), (None, None), (9, prose(9, 40), None, None), (10, "one"),
    ])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([(0, "x")]).limit(0)
