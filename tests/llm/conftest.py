"""Tables with the cases every operator must handle."""

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
#: doc_id, text; other columns have the names that operators use inside.
EDGE_ROWS = [
    (1, "the same text of several words here"),
    (2, "the same text of several words here"),
    (3, ""),
    (4, None),
    (5, "short"),
    (6, LONG),
    (7, LONG),
    (8, "repeated row with some words in it"),
    (8, "repeated row with some words in it"),
    (None, "no identifier but a text of its own"),
    (9, " \n\t "),
]
INSIDE = "id part body row text_sha256 kept score ids n label path sequence_id frame".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in INSIDE
)


def frame(spark, rows):
    filled = [
        (i, t, "en", None if i == 5 else "src", len(t or "")) + tuple("x" for _ in INSIDE)
        for i, t in rows
    ]
    return spark.createDataFrame(filled, SCHEMA).withColumn("a.b", F.lit(1))


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, EDGE_ROWS).repartition(3, "n_chars")


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, EDGE_ROWS).filter("false")


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)
