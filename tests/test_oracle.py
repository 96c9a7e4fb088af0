"""Every registered query against its SQL twin (DuckDB) on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    """All but those that SQL cannot express: some of the training-data operators, which have tests of their own."""
    without = {n for n in QUERIES if n not in SQL}
    assert all(re.match(r"op\d+_|pipeline$", n) for n in without) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "order_date"
