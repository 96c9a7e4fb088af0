"""Results stay exact when one key holds a third of the rows (vs the SQL twins on the same data)."""

import pytest
from pyspark.sql import functions as F

from orderlens.operators import load, marts, quality, staging
from orderlens.plans import oracle
from orderlens.plans.edge import edge
from orderlens.sources import fixtures
from tests.conftest import SF_SMALL
from tools.oracle_check import duck, rows_of

HOT_CUSTOMER = "CASE WHEN CAST(customer_id AS BIGINT) % 3 = 0 THEN 'hot' ELSE customer_id END"
HOT_ORDER = "CASE WHEN CAST(split_part(order_id, '-', 1) AS BIGINT) % 3 = 0 THEN 'hot' ELSE order_id END"


def _skewed_raw(spark):
    raw = fixtures.raw_orders(spark, SF_SMALL)
    hot_order = "CASE WHEN CAST(split(order_id, '-')[0] AS BIGINT) % 3 = 0 THEN 'hot' ELSE order_id END"
    return raw.withColumn("customer_id", F.expr(HOT_CUSTOMER)).withColumn("order_id", F.expr(hot_order))


def _skewed_sql(name):
    sql = oracle.SQL[name]
    skew = (f"raw_skewed AS (SELECT * REPLACE ({HOT_CUSTOMER} AS customer_id, {HOT_ORDER} AS order_id) "
            f"FROM raw),\nstg AS (")
    sql = sql.replace(",\nstg AS (", ",\n" + skew, 1)
    return sql.replace("FROM raw WHERE order_timestamp IS NOT NULL", "FROM raw_skewed WHERE order_timestamp IS NOT NULL")


@pytest.mark.parametrize("name,build", [
    ("customer_360", lambda raw: marts.customer_360(staging.stg_orders(raw))),
    ("stg_customers", lambda raw: staging.stg_customers(staging.stg_orders(raw))),
    ("daily_revenue", lambda raw: marts.daily_revenue(staging.stg_orders(raw))),
    ("fraud_analysis", lambda raw: marts.fraud_analysis(staging.stg_orders(raw))),
    ("test_unique", lambda raw: quality.test_unique(staging.stg_orders(raw), "order_id")),
])
def test_hot_keys_exact(spark, name, build):
    raw = _skewed_raw(spark)
    assert raw.filter("customer_id = 'hot'").count() * 3 >= raw.count() * 0.9
    got = edge(build(raw))
    s_cols, s_rows = rows_of(got.columns, [tuple(r) for r in got.collect()])
    res = duck(SF_SMALL).execute(_skewed_sql(name))
    d_cols, d_rows = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols and s_rows == d_rows


def test_hot_order_id_first_arrival(spark):
    raw = _skewed_raw(spark)
    first = load.first_arrival(raw)
    assert first.filter("order_id = 'hot'").count() == 1
    assert first.count() == raw.select("order_id").distinct().count()
