"""Small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

import random

import pytest


def lorem(seed: int, n: int) -> str:
    """Invented words, the same for the same seed."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randrange(2, 9))) for _ in range(n))


ROWS = [
    (1, "Alpha beta\tgamma\n", "en", "s1"), (2, "alpha  betagamma", None, "s1"), (3, "Alphabeta gamma", "en", None),
    (4, None, "en", "s2"), (5, "", None, "s2"), (6, " \n\t", "de", "s2"), (7, lorem(7, 4000), "en", "s1"),
    (8, lorem(7, 4000) + " tail", "en", "s1"), (9, lorem(9, 60), "de", "s3"), (9, lorem(9, 60), "de", "s3"),
    (None, lorem(9, 60), "de", "s3"), (10, "é日本 <|endoftext|> ß", "fr", "s3"), (11, "aaaa" * 300, None, "s1"),
]
SCHEMA = "doc_id long, text string, lang string, source string, gid string, `a.b` int, n long"


@pytest.fixture(scope="session")
def odd(spark):
    """Columns whose names the operators use inside, and one with a dot."""
    return spark.createDataFrame([(*row, "x", i, None) for i, row in enumerate(ROWS)], SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
