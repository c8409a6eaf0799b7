"""Builders shared by the tests of the training-data operators."""

from __future__ import annotations

import random

import pytest

WORDS = ("alpha beta gamma delta river stone cloud paper green seven under north quiet light "
         "maple tower orange silver garden window").split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(words))


#: Null in any column, empty and blank texts, a very long one, ties and repeated rows.
ODD_ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, None),
    (4, "x " * 60_000, "en", "b", 1), (None, prose(1, 80), "en", "c", 1), (None, prose(1, 80), "en", "c", 1),
    (5, prose(2, 80), None, "c", None), (5, prose(2, 80), None, "c", None), (6, prose(2, 80), "de", None, 9),
    (7, prose(3, 80), "de", "a", 2), (7, prose(4, 80), "de", "a", 2), (8, "Ünïcödé 😀 \x00\x01 text", "fr", "a", 3),
]
ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns named like those that the operators work with.
CLASHES = ("row_key", "id", "h", "fp", "ranges", "cleaned", "language", "bin_id", "drop", "ROOT")


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    return docs.select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce("source", F.lit("none"))).alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


def documents(spark, rows):
    """Rows ``(doc_id, text)`` as documents."""
    return spark.createDataFrame([(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)], ODD_SCHEMA)
