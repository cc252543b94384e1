import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

#: Rows that every operator must stand: nulls, blanks, ties, repeated rows, columns of clashing names.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "a"),
    (2, None, None),
    (3, "", "b"),
    (4, " \n\t ", "b"),
    (5, "the quick brown fox jumps over the lazy dog", "a"),
    (5, "the quick brown fox jumps over the lazy dog", "a"),
    (None, "no id", "c"),
    (7, "é 漢字 😀 <|endoftext|> </s>[INST] x [/INST] \\", "c"),
    (8, "x", None),
    (9, "word " * 30_000, "long"),
]


@pytest.fixture(scope="session")
def odd(spark):
    schema = "doc_id long, text string, node string"
    return spark.createDataFrame(ODD, schema).withColumns({"kept": _lit("mine"), "key": _lit(1), "count": _lit(2), "score": _lit(3)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def _lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)
