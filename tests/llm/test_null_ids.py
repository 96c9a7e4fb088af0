"""Rows without an id in the queries that hold documents out of training."""

import zlib

import pytest

from orderlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.fixture
def with_nulls(spark, scratch):
    folder = f"{scratch}/null-ids"
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    nulls = docs.limit(3).selectExpr(*("CAST(NULL AS BIGINT) AS doc_id" if c == "doc_id" else c for c in docs.columns))
    docs.unionByName(nulls).write.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    labels.unionByName(spark.createDataFrame([(None, 1, 0)], labels.schema)).write.parquet(f"{folder}/labels.parquet")
    return folder, docs.count() + 3


@pytest.mark.parametrize("name, n, remainder", [("op1_quality", 4, 2), ("op8_language_id", 5, 0)])
def test_held_out_is_never_null(spark, with_nulls, name, n, remainder):
    folder, count = with_nulls
    found = QUERIES[name](spark, folder).select("doc_id", "held_out", "score").collect()
    assert len(found) == count and sum(r.doc_id is None for r in found) == 3
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % n == remainder) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
