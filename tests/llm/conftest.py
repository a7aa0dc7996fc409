from __future__ import annotations

import pytest

from gablework.llm.shipping import ship

# Rows that every operator must take: null and empty text, repeated rows, null and equal keys, a clashing column.
ODD_ROWS = [
    (1, None, "a"),
    (2, "", "b"),
    (3, " \n\t ", None),
    (4, "one two", "c"),
    (4, "one two", "c"),
    (None, "null key, some words here", "d"),
    (None, None, None),
    (5, "é ß 😀 Σς İ <|endoftext|> \x85 x", "e"),
    (6, "word " * 30_000, "f"),
]


@pytest.fixture(scope="session")
def shipped(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def odd(shipped):
    return shipped.createDataFrame(ODD_ROWS, "doc_id long, text string, k1 string")


@pytest.fixture(scope="session")
def empty(shipped):
    return shipped.createDataFrame([], "doc_id long, text string, k1 string")
