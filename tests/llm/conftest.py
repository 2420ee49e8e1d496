import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id int, n_words int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    letters = str.maketrans("0123456789", "abcdefghij")
    long = " ".join(f"word{i % 7919}" for i in range(7919)).translate(letters)
    passage = " ".join(f"pass{i}" for i in range(70)).translate(letters)
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en"),
        (2, "Alpha beta GAMMA delta epsilon zeta eta theta iota kappa", None),
        (3, None, "en"),
        (4, "", "en"),
        (5, " \t\n", None),
        (6, long, "en"),
        (7, f"start {passage} end", "en"),
        (8, f"{passage} other end", "en"),
        (9, "two words", "en"),
        (10, "Two words", "en"),
        (None, f"{passage}", "en"),
        (None, None, None),
        (11, "x" * 50_000, "en"),
        (12, f"start {passage} end", "en"),
        (12, f"start {passage} end", "en"),
        (13, "#### $$$ *** ||| <<< >>> %%% &&& ### $$$ *** |||", "en"),
    ]
    return spark.createDataFrame([(i, t, g, None, None, "x", 5, None) for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
