from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

LONG = "word " * 3000 + "end"
EDGE = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "a", "x"),
    (2, "The quick brown fox jumps over the lazy dog again and again", "b", "y"),  # a copy
    (2, "The quick brown fox jumps over the lazy dog again and again", "b", "y"),  # a repeated row
    (3, None, None, "z"), (4, "", "a", None), (5, " \t\n ", None, None), (6, LONG, "b", "x"), (7, "x", "c", "x"),
    (8, "Ünïcode  text with <|endoftext|> and\n\n  runs   of space 's", "c", "x"), (None, "no id here", "a", "x"), (9, "ab" * 900, "a", "x"),
]
# extra columns whose names clash with those used inside
SCHEMA = "doc_id long, text string, source string, score string"


@pytest.fixture(scope="session")
def edge(spark):
    clashing = {c: F.lit("clash") for c in ("row", "fp", "node", "name", "held_out", "digest", "size", "length")}
    return spark.createDataFrame(EDGE, SCHEMA).withColumns(clashing).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return docs.orderBy("doc_id").collect()
