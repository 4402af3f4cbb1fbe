import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))])


@pytest.fixture(scope="session")
def documents(spark):
    """Documents table from (doc_id, text) pairs; extra columns carry names that operators use inside."""
    def make(rows, **extra):
        kinds = T.StructType([*DOCS.fields, *(T.StructField(k, T.StringType()) for k in extra)])
        return spark.createDataFrame([(i, t, None, "s", None, *extra.values()) for i, t in rows], kinds)
    return make


#: Nulls, empty and blank texts, ties, repeats and one very long text.
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "Two words"), (7, "é ß   x"), (8, "word " * 30_000), (9, "a" * 50_000),
       (10, "the same text of some words here\nand a line"), (11, "the same text of some words here\nand a line")]


@pytest.fixture(scope="session")
def odd():
    return ODD
