from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and blank texts, a repeated row, a repeated id and an unknown column."""
    long_text = " ".join(f"w{i % 700}x{i}" for i in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog tonight", "en", "a", 51, 0),
        (1, "the quick brown fox jumps over the lazy dog tonight", "en", "a", 51, 0),
        (2, "The Quick brown fox jumps over the lazy dog tonight", "en", None, 51, 0),
        (3, None, "en", "a", None, 0),
        (4, "", None, "a", 0, 0),
        (5, " \n\t ", "en", "b", 4, 0),
        (None, "password=abcdefgh12 and nothing more", "en", "b", 36, 0),
        (6, "another text under an id that comes twice", "en", "b", 41, 0),
        (6, "the second text of the id that comes twice", "en", "b", 42, 0),
        (7, long_text, "en", "a", len(long_text), 0),
        (8, "one two", "en", None, 7, None),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
