from __future__ import annotations

import pytest

#: Columns named like ones the operators use inside.
CLASHING = (
    "n_words", "score", "print", "key", "text_key", "doc", "bucket", "block", "batch", "codes", "good", "stratum",
    "node", "raw", "slot", "size", "t", "w", "marks", "places", "lo", "hi", "sequence_id", "_text",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def long_text(n: int = 30_000) -> str:
    return " ".join(f"w{i % 977}x{i % 13}" for i in range(n))


ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", "en", "a", 5),
    (4, "one", "en", None, 3),
    (5, "12 34 !!", None, "a", 8),
    (6, long_text(), "en", "a", None),
    (7, long_text(), "en", "a", None),
    (8, "MIT License ünï ſ ΑΣ 日本 \x1c \x85 <|endoftext|>", "de", "a", 1),
    (8, "MIT License ünï ſ ΑΣ 日本 \x1c \x85 <|endoftext|>", "de", "a", 1),
    (None, "a row without id " * 12, "fr", "a", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    for name in CLASHING:
        from pyspark.sql import functions as F

        rows = rows.withColumn(name, F.lit("other"))
    return rows


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def plain(docs):
    """The small table as Python rows."""
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
