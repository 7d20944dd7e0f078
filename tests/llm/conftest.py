import pytest


@pytest.fixture(scope="session")
def words_of():
    """A tiny seeded text maker."""
    import random

    def make(seed: int, n: int) -> list[str]:
        r = random.Random(seed)
        return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(n)]

    return make


@pytest.fixture()
def odd_docs(spark, words_of):
    """Documents with nulls, empty and very long texts, repeated rows, ties
    and extra columns whose names the operators use inside."""
    base = words_of(1, 60)
    near = base[:30] + ["changed"] + base[31:]
    rows = [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "One"), (8, "one"),
        (9, "a b c"), (10, "A B\tc"), (None, " ".join(words_of(2, 40))), (None, " ".join(words_of(2, 40))), (11, " ".join(words_of(3, 30_000))),
        (12, "same row here with six words"), (12, "same row here with six words"), (13, "é ñ ß Ünï \U0001f600 x"), (14, "\n".join([" ".join(base), " ".join(words_of(4, 30))])),
    ]
    return spark.createDataFrame(
        [(i, t, "x", 1, 2, 3, "k") for i, t in rows], "doc_id long, text string, sig string, part int, n int, hot int, key string"
    )
