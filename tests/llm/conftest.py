"""Small tables and brute-force helpers for the training-data operators."""

import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def make(spark):
    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not here")
    return DATA


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_docs(make):
    """Nulls in every column, empty and blank texts, repeated rows, equal ids with other texts, a long text."""
    long = "word " * 30_000 + "end"
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 57),
        (1, "The quick brown fox jumps over the lazy dog and runs away", "en", "a", 57),
        (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "en", "b", 4), (None, "a text without an id", "en", None, 20),
        (5, long, "en", "a", len(long)), (6, "password=abc123def", "en", "a", 18), (7, "Ünïcode ﬁn — 中文 字", "de", "b", 18),
    ]
    return make(rows, DOCS)
