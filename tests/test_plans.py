"""Plan shapes that matter at scale (checked on the physical plan text)."""

import re

from pyspark.sql import functions as F

from orderlens.operators import load, marts, staging
from orderlens.plans import order_flow
from orderlens.sources import fixtures
from orderlens.streaming.windows import window_revenue
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_every_exchange(plan: str, func: str) -> bool:
    """Every hash exchange is fed by a partial aggregate of `func`."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = "\n".join(lines[i + 1:i + 3])
            if "partial_" not in below and "Aggregate" in "\n".join(lines[i - 2:i]):
                return False
    return f"partial_{func}" in plan


def test_customer_360_is_one_aggregation_without_join(spark):
    df = marts.customer_360(staging.stg_orders(fixtures.raw_orders(spark, SF_SMALL)))
    plan = _plan(df)
    top = plan.split("Exchange hashpartitioning(customer_age_days")[0]
    assert "Join" not in top
    assert "partial_count(distinct" in plan or "partial_count" in plan


def test_hot_key_paths_combine_map_side(spark):
    raw = fixtures.raw_orders(spark, SF_SMALL)
    # first arrival: partial min of the row struct before the shuffle on order_id
    assert "partial_min(struct" in _plan(load.first_arrival(raw))
    # window revenue: partial sums per (window, category)
    clean = order_flow.clean_orders(fixtures.order_topic(spark, SF_SMALL))
    assert "partial_sum" in _plan(window_revenue(clean))
    # distinct counts shuffle on (key, order_id) before the per-key merge
    plan = _plan(staging.stg_customers(staging.stg_orders(raw)))
    assert re.search(r"Exchange hashpartitioning\(customer_id#\d+, order_id#\d+", plan)


def test_payload_parsed_once(spark):
    clean = order_flow.clean_orders(fixtures.order_topic(spark, SF_SMALL))
    plan = _plan(window_revenue(clean))
    # one parse of the payload (the other from_json reads the fixture's props)
    assert plan.count("from_json") == 2
    assert "Generate inline" in plan


def test_scan_reads_only_needed_columns(spark):
    df = marts.hourly_metrics(fixtures.raw_orders(spark, SF_SMALL))
    plan = _plan(df)
    li = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan)
    cols = {c.split("#")[0] for c in li.group(1).split(",")}
    assert cols == {"l_orderkey", "l_partkey", "l_extendedprice"}  # join keys + amount only
    assert "l_shipdate" not in plan and "l_comment" not in plan


def test_validation_filter_is_pushed_into_the_lake_scan(spark, scratch):
    from orderlens.sinks.writers import write_partitioned
    from orderlens.sources.files import scan_valid

    write_partitioned(order_flow.lake_rows(fixtures.order_topic(spark, SF_SMALL), fixtures.F1_RULE), scratch + "/l")
    df = scan_valid(spark, scratch + "/l").filter(F.col("amount") > 100)
    assert "PushedFilters: [IsNotNull(amount), GreaterThan(amount,100.0)]" in _plan(df)
