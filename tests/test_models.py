"""Staging and mart semantics on hand-made rows: segments, bands, rounding, NULL vs 0."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.functions import customer_segment, risk_category, round_ratio, time_of_day
from orderlens.operators import marts, staging

STG_SCHEMA = ("order_id string, customer_id string, product_id string, quantity int, price decimal(10,2), "
              "total_amount decimal(10,2), order_timestamp timestamp, customer_age_days int, is_fraud boolean, "
              "processed_time timestamp, order_date date, order_hour int, order_day_of_week int")


def _stg(spark, rows):
    out = []
    for oid, cid, amt, ts, age, fraud in rows:
        out.append((oid, cid, "p", 1, Decimal("1.00"), Decimal(str(amt)), ts, age, fraud, ts, ts.date(),
                    ts.hour, (ts.isoweekday() % 7)))
    return spark.createDataFrame(out, STG_SCHEMA)


@pytest.mark.parametrize("age,seg", [(29, "new"), (30, "active"), (90, "active"), (91, "loyal"), (None, None)])
def test_segment_edges(spark, age, seg):
    df = spark.createDataFrame([(age,)], "a int")
    assert df.select(customer_segment("a").alias("s")).first().s == seg


@pytest.mark.parametrize("hour,label", [(0, "night"), (6, "night"), (7, "morning"), (12, "morning"),
                                        (13, "afternoon"), (18, "afternoon"), (19, "evening")])
def test_time_of_day_edges(spark, hour, label):
    df = spark.createDataFrame([(hour,)], "h int")
    assert df.select(time_of_day("h").alias("t")).first().t == label


@pytest.mark.parametrize("rate,band", [("4.99", "low_risk"), ("5.00", "medium_risk"), ("10.00", "medium_risk"),
                                       ("10.01", "high_risk"), (None, "low_risk")])
def test_risk_bands(spark, rate, band):
    df = spark.createDataFrame([(Decimal(rate) if rate else None,)], "r decimal(10,2)")
    assert df.select(risk_category("r").alias("b")).first().b == band


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(Decimal("1.005"), 1), (Decimal("-0.125"), 1), (Decimal("2.00"), 3)],
                               "n decimal(10,3), d bigint")
    got = [r.x for r in df.select(round_ratio("n", "d").alias("x")).collect()]
    assert got == [Decimal("1.01"), Decimal("-0.13"), Decimal("0.67")]


def test_stg_orders_derives_dow_and_dedups(spark):
    from orderlens.sources.fixtures import raw_orders

    raw = raw_orders(spark, "/root/testdata/sf0.001")
    stg = staging.stg_orders(raw.unionByName(raw))
    assert stg.count() == staging.stg_orders(raw).count() == raw.count()
    sunday = spark.createDataFrame([(dt.datetime(2024, 1, 7, 10),)], "t timestamp")
    from orderlens.functions import pg_day_of_week
    assert sunday.select(pg_day_of_week("t").alias("d")).first().d == 0


def test_daily_revenue_zero_vs_hourly_null_without_fraud(spark):
    t = dt.datetime(2024, 1, 1, 10)
    stg = _stg(spark, [("o1", "c1", 10.0, t, 50, False), ("o2", "c2", 20.0, t, 50, False)])
    daily = marts.daily_revenue(stg).first()
    assert daily.fraud_revenue == 0 and daily.fraud_orders == 0 and daily.fraud_revenue_pct == 0
    raw = stg.withColumnRenamed("total_amount", "amount")
    hourly = marts.hourly_metrics(raw).first()
    assert hourly.fraud_amount is None and hourly.fraud_count == 0


def test_customer_360_matches_join_form(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("o1", "c1", 10.0, t, 20, True), ("o2", "c1", 30.0, t, 40, False), ("o3", "c1", 30.0, t, 40, False),
            ("o4", None, 5.0, t, 5, True), ("o5", "c2", 7.0, t, 95, False)]
    stg = _stg(spark, rows)
    got = {r.customer_id: r for r in marts.customer_360(stg).collect()}
    assert got["c1"].customer_segment == "active" and got["c1"].total_orders == 3
    assert got["c1"].fraud_rate_pct == Decimal("33.33") and got["c1"].risk_category == "high_risk"
    assert got[None].customer_segment is None and got[None].lifetime_value is None
    assert got[None].fraud_orders == 1
    cust = staging.stg_customers(stg)
    joined = (stg.join(cust.select("customer_id", "customer_segment", "lifetime_value", "total_orders"),
                       "customer_id", "left")
              .groupBy("customer_id", "customer_segment", "lifetime_value", "total_orders")
              .agg(F.count_if("is_fraud").alias("fraud_orders")))
    assert {r.customer_id: r.fraud_orders for r in joined.collect()} == {k: v.fraud_orders for k, v in got.items()}


def test_fraud_analysis_uses_segment_of_all_orders(spark):
    t = dt.datetime(2024, 1, 1, 3)
    # c1's fraud order has age 10 but the customer's max age is 95 -> loyal
    stg = _stg(spark, [("o1", "c1", 100.0, t, 10, True), ("o2", "c1", 1.0, t, 95, False)])
    row = marts.fraud_analysis(stg).first()
    assert row.customer_segment == "loyal" and row.time_of_day == "night" and row.fraud_count == 1
    assert row.min_customer_age == 10 and row.max_customer_age == 10


def test_model_dag_builds_in_order(spark):
    from orderlens.plans.models import build_models, topological
    from orderlens.sources.fixtures import raw_orders

    names = [m.name for m in topological()]
    assert names.index("stg_orders") < names.index("stg_customers") < names.index("mart_fraud_analysis")
    frames = build_models(spark, raw_orders(spark, "/root/testdata/sf0.001"))
    assert frames["mart_daily_revenue"].count() > 0
    assert frames["mart_fraud_analysis"].columns[-1] == "time_of_day"


def test_rule_and_window_from_env():
    from orderlens.config import FraudRule, WindowSpec

    rule = FraudRule.from_env({"FRAUD_AMOUNT_THRESHOLD": "500", "FRAUD_TENURE_THRESHOLD": "7"})
    assert (rule.amount_threshold, rule.tenure_days) == (500.0, 7)
    assert rule.reason == "High value order (>$500.0) from new customer (<7 days)"
    assert FraudRule.from_env({}) == FraudRule()
    assert WindowSpec.from_env({"WINDOW_DURATION": "1 minute"}).window == "1 minute"


def test_cli_load_and_verify(spark, scratch, capsys):
    from orderlens.__main__ import main
    from orderlens.plans import order_flow
    from orderlens.sinks.writers import write_partitioned
    from orderlens.sources import fixtures

    lake = f"{scratch}/lake"
    write_partitioned(order_flow.lake_rows(fixtures.order_topic(spark, "/root/testdata/sf0.001"),
                                           fixtures.F1_RULE), lake)
    assert main(["load", "--lake", lake, "--target", f"{scratch}/raw"]) == 0
    out = capsys.readouterr().out
    assert '"inserted": ' in out
    fixtures.raw_orders(spark, "/root/testdata/sf0.001").write.parquet(f"{scratch}/f2")
    code = main(["verify", "--raw", f"{scratch}/f2"])
    assert code == 1  # F2 has duplicate order ids and its own fraud rule: not all checks pass


def test_fraud_analysis_same_with_materialized_customers(spark):
    from orderlens.sources.fixtures import raw_orders

    stg = staging.stg_orders(raw_orders(spark, "/root/testdata/sf0.001"))
    a = marts.fraud_analysis(stg)
    b = marts.fraud_analysis(stg, staging.stg_customers(stg))
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_models_written_as_tables_and_rollup_refreshes(spark):
    from orderlens.plans.models import build_models
    from orderlens.sources.fixtures import raw_orders

    raw = raw_orders(spark, "/root/testdata/sf0.001")
    frames = build_models(spark, raw, write_tables=True)
    n = spark.table("analytics.hourly_metrics").count()
    assert n == marts.hourly_metrics(raw).count() and spark.table("marts.mart_daily_revenue").count() > 0
    build_models(spark, raw, write_tables=True)  # refresh in place: same rows, not appended
    assert spark.table("analytics.hourly_metrics").count() == n
    assert "int_customer_360" in frames
