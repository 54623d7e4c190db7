import random

import pytest

FOLDER = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def prose(rng):
    """prose(n): n random words, all but surely unlike any other text."""

    def make(n, seed=None):
        own = random.Random(seed) if seed is not None else rng
        return " ".join(own.choice(WORDS) + str(own.randrange(50)) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): a table with the columns of documents and some that clash with inner names."""

    def make(rows):
        full = [(i, t, "en", s, len(t or ""), 1, "x", 2) for i, t, s in rows]
        return spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, _fp int, cls string, size int",
        )

    return make
