from __future__ import annotations

import pytest

from brooklog.llm.queries import workers_find_package


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    workers_find_package(spark)


LONG = " ".join(f"long{i}" for i in range(30_000))

#: Nulls, empty texts, a very long one, ties, repeated rows, and clashing column names.
ODD_ROWS = [
    (1, "The first of all lines has these ten words in it.\nAnother line.", 7),
    (2, "The first of all lines has these ten words in it.\nAnother line.", 7),
    (3, None, 1),
    (4, "", 2),
    (5, " \n\t\n ", 3),
    (6, "one", 4),
    (7, LONG, None),
    (8, LONG + " end", 5),
    (None, "The first of all lines has these nine words in it.", 6),
    (None, None, 6),
    (9, "repeated row of exactly these eight short words", 8),
    (9, "repeated row of exactly these eight short words", 8),
    (9, "repeated id but other words than the row before", 8),
    (10, "Naïve café – 日本語 \U0001F600 Ünïcode words ✓ and more of the same", 9),
]
ODD_SCHEMA = (
    "doc_id long, text string, id long, doc string, tag string, n int, lines string, "
    "left string, words string, _all string, _m string, row string, removed string"
)


@pytest.fixture
def odd(spark):
    rows = [(d, t, x, *["x"] * 2, 1, *["y"] * 7) for d, t, x in ODD_ROWS]
    return spark.createDataFrame(rows, ODD_SCHEMA)


@pytest.fixture
def none(odd):
    return odd.limit(0)
