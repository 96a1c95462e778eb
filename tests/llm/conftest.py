"""Small tables that hold the awkward cases: NULLs, empty and very long texts, ties, repeated rows, clashing names."""

import random

import pytest

LONG = " ".join(f"w{i % 4999}" for i in range(30_000))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n int, id string, `row` int, quality string"


def awkward_rows():
    base = "the quick brown fox jumps over the lazy dog and runs away from here to there every single day"
    rows = [
        (1, "", "en", "a", 0), (2, None, "en", "a", None), (3, " \n\t ", None, "b", 4), (4, "one two", "en", None, 7),
        (5, LONG, "en", "b", len(LONG)), (6, base, "en", "a", len(base)), (7, base.upper(), "en", "c", len(base)),
        (8, base + " twice", "en", "a", 0), (9, "línea única\nlínea única\nañadió ß Ünï 😀 漢字", "es", "ü", 40),
        (9, "línea única\nlínea única\nañadió ß Ünï 😀 漢字", "es", "ü", 40), (None, base, "en", "a", 1), (10, "...!?\n\n", "de", None, 5),
        (11, "<|endoftext|> a <|startoftext|>", "fr", "a", 1), (12, "x", None, None, None), (13, "x", "en", "a", 1),
    ]
    return [(*r, "own", 7, "id", 3, "good") for r in rows]


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"v{int(rng.random() ** 2 * vocabulary)}" for _ in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (4, 1, 0), (6, 1, 0), (6, None, 1), (8, 1, 0), (99, 1, 1), (None, 0, 0)],
                                 "doc_id long, quality int, toxic int")
