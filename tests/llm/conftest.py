import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """All 200 documents of the smallest table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and
    extra columns under names that operators use themselves."""
    long_text = " ".join(f"word{i % 977} mot{i % 613}" for i in range(60_000))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35), (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35),
        (2, None, "en", "a", None), (3, "", None, None, 0), (4, " \t\n ", "fr", "b", 4), (5, "  été 12 ### ", "fr", "b", None),
        (6, long_text, "en", "b", None), (7, passage, "de", None, None), (8, "before " + passage + " after that", "de", "c", None),
        (9, "one", "en", "c", 3), (10, "one", "en", "c", 3), (11, "12 34 %% !!", None, "c", 11),
        (12, "\U0001f600 emoji \U00010400 wide", "en", "\U00010400", None), (13, "the the the " * 30, "en", "￿", None),
    ]
    rows += [(None, "no id here at all today", "en", "a", None), (None, None, None, None, None), (None, "alpha beta gamma delta epsilon zeta", None, "a", 35)]
    extra = "row struct<a:int>, _id string, _th string, node string, score string, size string, length string, copies string, n_words string, lang_pred int"
    filler = ((1,), "i", "t", "n", "s", "z", "l", "c", "w", 5)
    return spark.createDataFrame([(*r, *filler) for r in rows], f"{DOCUMENT}, {extra}").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)
