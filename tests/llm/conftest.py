import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket string, row_id string, hits string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, columns with clashing names."""
    long_text = " ".join(f"w{i % 977} x{i % 13}" for i in range(60_000))
    rows = [
        (1, "One two three four five six seven.", "en", "a", 1, "b", "r", "h"),
        (1, "One two three four five six seven.", "en", "a", 1, "b", "r", "h"),
        (2, None, "en", "a", None, None, None, None),
        (3, "", "fr", None, 0, "b", "r", "h"),
        (4, " \t\n ", None, "b", 4, "b", "r", "h"),
        (None, "one two three four five six seven.", "en", "b", 5, "b", "r", "h"),
        (None, None, None, None, None, None, None, None),
        (5, "one TWO three four five six seven.", "de", "c/d/e", 5, "b", "r", "h"),
        (6, long_text, "en", "a", 6, "b", "r", "h"),
        (7, long_text, "en", "a", 7, "b", "r", "h"),
        (8, "two words", "en", "a", 7, "b", "r", "h"),
        (9, "Two WORDS", "en", "é", 7, "b", "r", "h"),
        (10, "😀 é ü " * 30, "en", "é", 7, "b", "r", "h"),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
