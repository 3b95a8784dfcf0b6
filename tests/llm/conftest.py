"""Small tables for the text operators: planted cases and the driver's smallest documents."""

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
                    T.StructField("row", T.IntegerType())])


def prose(seed: int, n: int) -> str:
    """Invented prose that differs by seed."""
    a = ["stone", "river", "cloud", "amber", "violet", "north", "quiet", "lamp", "garden", "iron", "salt", "the", "of", "and", "in"]
    x, out = seed * 7919 + 13, []
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        w = a[x >> 16 & 15] if (x >> 16 & 15) < len(a) else f"w{x % 997}"
        out.append(w + ("." if i % 11 == 10 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with clashing extra columns (kept, row), from (doc_id, text) pairs."""
    def make(pairs, lang="en"):
        rows = [(i, t, lang, "s", None if t is None else len(t), "x", 1) for i, t in pairs]
        return spark.createDataFrame(rows, DOC)
    return make


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(5, 80)), (5, prose(5, 80)), (None, "nobody at a.b@c.de"),
       (7, "é日本 😀 ﬁn"), (8, "a" * 300_000), (9, prose(9, 40_000)), (10, prose(5, 80)), (11, "x\r\n\r\ny  z  q")]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return make_docs(ODD)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture(scope="session")
def small_docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
