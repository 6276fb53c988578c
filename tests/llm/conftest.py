import pytest
from pyspark.sql import types as T

TEXTS = [
    None, "", " \n\t", "one", "One two", "the cat sat on the mat and the dog ran off with the cat's hat today",
    "the cat sat on the mat and the dog ran off with the cat's hat today",
    "the cat sat on the mat and the dog ran off with the cat's hat today!",
    "aaaa " * 300, "Ünïcödé 漢字 🙂 ▁ <|endoftext|> \x00 x", "line one of five words here\nsecond line of five words\n\nlast",
    "something else first of all\nline one of five words here\nsecond line of five words\n\nlast", "z" * 3000,
]


@pytest.fixture(scope="session")
def hostile():
    """Rows with nulls, empty and long texts, ties, repeated rows and ids, and clashing extra columns."""
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(5, TEXTS[5]), (7, "other text under the same id"), (None, "no id here"), (None, None)]
    return [(i, t, "k", 1.5, "h") for i, t in rows]


SCHEMA = "doc_id long, text string, k string, score double, h string"


@pytest.fixture(scope="session")
def hostile_docs(spark, hostile):
    return spark.createDataFrame(hostile, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))
