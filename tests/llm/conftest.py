import random

import pytest

EDGE = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "one two three four five six"),
    (6, "one two three four five six"),
    (6, "one two three four five six"),
    (7, "É è 漢字 🙂  two  spaces\n\nand lines\n"),
    (None, "no id here"),
    (8, "a" * 3000),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, blanks, repeated rows, long words, and columns whose names clash with outputs."""
    rows = [(i, t, "x", 1, True, 0.5) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, start int, kept boolean, length double")


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(900)]

    def make(n, seed):
        return " ".join(random.Random(seed).choices(vocabulary, k=n))

    return make
