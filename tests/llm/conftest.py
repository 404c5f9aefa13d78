import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(doc_id, text, lang, source)`` with columns whose names clash with those of results."""
    def make(rows, clash=()):
        frame = spark.createDataFrame([(*row, len(row[1] or "")) for row in rows], DOCS)
        for name in clash:
            frame = frame.selectExpr("*", f"7 AS `{name}`")
        return frame
    return make


LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))
ODD = [(1, None, "en", "a"), (2, "", None, None), (None, "the null id has words", "en", "a"), (3, LONG, "en", "b"), (4, "one two", "de", "a"),
       (4, "one two", "de", "a"), (5, "  \t\n ", "xx", None), (6, "one two", "en", "b"), (7, "Ünïcode 漢字 K\u212a 😀 three four five six", "fr", "c")]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD, clash=("size", "start", "words", "sketch", "n", "key"))


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([], clash=("size",))


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"
