"""Helpers of the text operator tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows and columns with clashing names."""
    words = [f"word{i}" for i in range(60)]
    rows = [
        (1, " ".join(words), "en", "a", 1), (2, " ".join(words), "en", "a", 1), (3, "", "en", None, 0), (4, None, None, None, None),
        (5, "short text", "de", "b", 10), (5, "short text", "de", "b", 10), (6, "mail me at ann@example.com today", "en", "a", 5),
        (7, " ".join(words * 400), "en", "a", 9), (None, "no id here at all", "fr", "c", 3), (8, "\x00\t \n", "en", "a", 4),
        (9, "Ünïcödé ßtraße naïve 你好 世界 <|endoftext|> ''quoted'' it's 12345", "xx", "d", 2),
    ]
    clash = "text2 string, digest string, label int, score double, p int, node long, items array<string>"
    out = [(*r, "x", "d", 1, 0.5, 2, 3, ["q"]) for r in rows]
    return spark.createDataFrame(out, f"{DOCUMENT}, {clash}")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)
