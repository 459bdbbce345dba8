from __future__ import annotations

import pytest

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 20, "en", 5, "x"),
    (2, "The quick brown fox jumps over the lazy dog. " * 20, "en", 5, "x"),
    (3, None, "en", 0, None),
    (4, "", None, None, "y"),
    (5, " \n\t ", "de", 4, "y"),
    (6, "Ünïcödé wörds, ßtraße 漢字 \U0001f600 #hash $$ !!", "de", 1, "y"),
    (7, " ".join(f"word{i} of{i % 97}" for i in range(60_000)), "en", 1, "z"),
    (7, " ".join(f"word{i} of{i % 97}" for i in range(60_000)), "en", 1, "z"),
    (None, "a row without a number", "fr", 1, "z"),
    (9, "one", "fr", 3, "z"),
]
SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint, key string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and a column named like the operators' own."""
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
