from __future__ import annotations

import pytest

from waybill.llm.common import importable
from waybill.sources.scratch import Scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture
def space(spark):
    importable(spark)
    space = Scratch(spark)
    yield space
    space.drop()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Ids, texts and sources with nulls, empty texts, ties and a row given twice.
ODD = [
    (5, "a b  c\td e", "en", "s1", 11),
    (3, "a b c d e", "en", "s1", 9),
    (9, " a b c d e", "en", "s2", 10),
    (4, None, None, None, None),
    (7, "", "en", "s2", 0),
    (8, " \n", "de", "s3", 2),
    (2, "x " * 300 + "end", "en", "s1", 603),
    (6, "x " * 300 + "End", "en", "s1", 603),
    (1, "x  " * 300 + "end", "en", "s1", 903),
    (3, "a b c d e", "en", "s1", 9),
    (None, "a b c d e", "en", "s1", 9),
    (None, "only here", "en", None, 9),
    (3, "other text of the same id", "en", "s4", 25),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def clashing(spark):
    """Unique ids, and columns named as the operators name theirs."""
    rows = [(r, f"text {r % 3}", "en", "s", 6, r, "k", 1.5, [1]) for r in range(12)]
    more = "row_key long, keep_id string, score double, ids array<int>"
    return spark.createDataFrame(rows, f"{DOCS}, {more}")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
