import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tests.conftest import SF_SMALL

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("extra", StringType())])


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ",", ".\n"]) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids."""
    long_ = prose(1, 30_000, 5_000)
    return [
        (1, prose(2, 120), "x"),
        (2, None, None),
        (3, "", "x"),
        (None, prose(3, 60), None),
        (None, None, "y"),
        (5, prose(2, 120), "x"),
        (5, prose(2, 120), "x"),
        (6, prose(4, 80), "z"),
        (6, prose(5, 80), "z"),
        (7, long_, "long"),
        (8, " \n\t\n ", "blank"),
        (9, "one", "short"),
        (10, "ünïcödé 中文 \U0001f600 " * 20, "marks"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
