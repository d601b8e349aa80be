import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import pytest  # noqa: E402

from llm_data import prose  # noqa: E402

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and equal texts."""
    long = prose(99, 30_000)
    rows = [
        (1, "", "en", "a", 0), (2, None, "en", "a", None), (None, prose(1, 40), None, None, None), (3, prose(2, 60), "en", "a", 1), (3, prose(2, 60), "en", "a", 1),
        (4, prose(2, 60), "fr", "b", 1), (5, long, "en", "a", 1), (6, "   \n\t ", None, "b", 6), (7, "123 456 !!", "en", "b", 10), (8, prose(2, 58, " end here"), "en", "a", 1),
        (9, "é" * 50 + " 日本語 😀 ▁ \x00", "fr", "b", 5), (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
