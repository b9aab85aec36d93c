from __future__ import annotations

import pytest

LONG = "lorem ipsum  dolor\tsit amet\n" * 3000


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empties, ties, repeated rows, a very long text, and columns named like results."""
    rows = [
        (0, "a b  c", "x"), (1, "a b c", "y"), (2, "a\tb\nc", None), (3, None, "z"), (4, "", "z"), (5, LONG, "l"), (6, LONG + "!", "l"),
        (7, LONG.replace("\n", " "), "l"), (1, "a b c", "y"), (8, " a b c", "x"), (None, "a b c", "x"), (None, "only here", "x"), (9, "Ünï <|endoftext|> \U0001f600", "u"),
        (10, "a b c\x0b\x0c", "x"), (11, "same", "s"), (12, "same", "s"), (12, "other", "s"), (13, "\x00 \x85\xa0", "n"),
    ]
    wide = [(i, t, e, e, 1, 2, e, True, 3) for i, t, e in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, extra string, row string, at int, name int, keep_id string, kept boolean, shard int").repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, row string")
