import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, Rank int, _leak string"
LINE = "a line of some length that several documents share, word for word"
EDGE = [
    (1, f"first\n{LINE}\nlast words of the first text", "en", "s", 0, 1, "x"),
    (2, f"second\n{LINE}\nother words of the second text", "en", "s", 0, 1, "x"),
    (2, f"second\n{LINE}\nother words of the second text", "en", "s", 0, 1, "x"),
    (3, None, "en", "s", 0, None, None),
    (4, "", None, None, None, None, None),
    (None, f"no id\n{LINE}", "en", "s", 0, 1, "x"),
    (5, " ... 123 \n\n", "de", "s", 0, 1, "x"),
    (6, "Ä" * 30 + "\n" + "Ä" * 30, "de", "s", 0, 1, "x"),
    (7, "ab " * 30000, "fr", "s", 0, 1, "x"),
    (8, "<|endoftext|> it's  two  spaces \n\n and\ttabs \u00a0x, y. 3.5 \u2028 z", "en", "s", 0, 1, "x"),
    (9, "one", "en", "s", 0, 1, "x"),
    (-10, "one", "en", "s", 0, 1, "x"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    """(doc_id, text) of the smallest documents table."""
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
