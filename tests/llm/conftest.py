import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))

#: id, text: NULLs, empty and blank texts, very long ones, ties and repeated rows.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One two three four five six seven eight nine ten."),
    (4, "One two three four five six seven eight nine ten."), (5, "One two three four five six seven eight nine ten."),
    (6, LONG), (7, LONG + " end"), (None, "a row without id but with a few words"), (None, None), (8, "x"), (9, "naïve Ünïcode ßtraße 日本語 🙂"),
    (10, "<|endoftext|> in  the   middle<|endoftext|>"), (11, "12 34 %% !!"),
]
TEXT_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, TEXT_SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """Further columns with names that operators use themselves, one that differs in case only."""
    names = ("id", "key", "TEXT", "n_tokens", "score", "component_id", "node", "spans", "pii_spans", "hash", "Doc_ID", "_c0", "word")
    rows = odd.select("doc_id", "text", *[odd.doc_id.alias(f"x{i}") for i in range(len(names))])
    return rows.toDF("doc_id", "text", *names)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], TEXT_SCHEMA)
