from __future__ import annotations

import pytest

# (doc_id, text, lang, source, n_chars, __id): nulls in every column, empty and blank texts, ties, repeated
# rows, a long word without white space, and columns named like the operators' own
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 10, 7),
    (2, "the QUICK brown fox jumps over the lazy dog again and again", "en", "a", 10, 7),
    (2, "the QUICK brown fox jumps over the lazy dog again and again", "en", "a", 10, 7),
    (3, "Der schnelle braune Fuchs Übt und springt über den faulen Hund", "de", "b", None, None),
    (4, None, "de", "b", 0, 1),
    (5, "", "fr", None, 0, 1),
    (6, " \t\n\x0b ", "fr", None, 0, 1),
    (7, "one two", None, "c", 7, 1),
    (8, "One TWO", None, "c", 7, 1),
    (9, "x" * 9000 + "\nthis line is repeated here\n\nand this one is not", "en", "a", 9, 1),
    (10, "this line is repeated here\nTHIS LINE is repeated here  \nshort", "en", "a", 9, 1),
    (None, "a row without an id but with words and this line is repeated here", "en", "a", 9, 1),
    (11, "café naïve \U0001f600 日本 <|endoftext|> it's we'll  done　　x", "en", None, 9, 1),
    (12, " ".join(f"w{i % 700}" for i in range(3000)), "en", "b", 9, 1),
    (13, " ".join(f"w{i % 700}" for i in range(3000)) + " tail", "en", "b", 9, 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __id long"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
