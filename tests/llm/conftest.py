import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, home string, version string, key int, node int, kind int, n int, shard string, row_number int, amount int"
CLASH = ("h", "v", 1, 2, 3, 4, "s", 5, 6)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (id, text) or (id, text, lang, source), with further columns of clashing names."""

    def make(rows):
        full = [(*(r if len(r) == 4 else (*r, "en", "src1")), len(r[1] or ""), *CLASH) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(3)
    return ["".join(rng.choice(["th", "er", "on", "an", "ti", "re", "ou", "is"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def prose(vocabulary):
    """Seeded sentences."""

    def make(seed, n_words):
        rng, out, left = random.Random(seed), [], n_words
        while left > 0:
            k = min(left, rng.randint(3, 12))
            out.append(" ".join(rng.choice(vocabulary) for _ in range(k)).capitalize() + rng.choice([".", ".", "!", ".\n"]))
            left -= k
        return " ".join(out)

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls, empty and blank texts, a very long text, ties, repeated rows and ids, a null id."""
    long = prose(99, 30_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "one"),
        (6, "ONE two  three"),
        (7, long),
        (8, long),
        (9, prose(9, 80)),
        (9, prose(9, 80)),
        (9, prose(10, 80)),
        (None, prose(9, 80)),
        (None, None),
        (11, "é ñ ß ü 漢字 \x1f x"),
        (12, "a" * 500),
        (13, "a" * 700),
    ]
