import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent.parent))

LONG = "word soup " * 20_000


@pytest.fixture
def odd_documents(spark):
    """Nulls in each column, empty and very long texts, repeated rows, and columns named like those of the operators."""
    rows = [
        (1, "plain text of a few words here", "en", "a"),
        (1, "plain text of a few words here", "en", "a"),
        (2, None, "en", None),
        (3, "", None, "a"),
        (4, " \t\n", "en", "a"),
        (None, "a row without an id", "en", "a"),
        (5, LONG, "en", "a"),
        (6, "Größe 日本 😀\x00 end", "de", "b"),
        (7, "PLAIN text of a few words here", "en", "b"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "1 AS start", "'x' AS node", "2L AS key", "3 AS score", "array(1) AS ids", "4 AS task", "5 AS sig", "'p' AS row")


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
