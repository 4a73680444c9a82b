"""Fixtures and brute-force helpers of the training-data operators' tests."""

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"


@pytest.fixture()
def make_docs(spark):
    """Rows (doc_id, text[, source]) -> a documents table."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(partitions)

    return make


#: Nulls, empty and blank texts, ties, repeated rows, a very long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "same text here"), (6, "same text here"), (7, "long " * 30000),
    (None, "a text without an id"), (9, "repeated row"), (9, "repeated row"), (10, "Ünïcödé «ß» 日本語  x"), (11, "a\x00b c"),
]


@pytest.fixture()
def odd_rows():
    return list(ODD)


@pytest.fixture()
def documents(spark, sf001):
    return spark.read.parquet(f"{sf001}/documents.parquet")


@pytest.fixture()
def clashing(make_docs):
    """Documents with extra columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    def add(docs):
        names = ("size", "shard", "slot", "fp", "key", "chunk", "part", "kept", "_doc", "n_words", "a.b", "score", "in_0", "copies", "rank")
        return docs.withColumns({n: F.lit(n) for n in names})

    return add
