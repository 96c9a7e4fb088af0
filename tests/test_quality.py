"""Quality checks on rows with known violations; summary and error handling."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderlens.config import FraudRule
from orderlens.operators import quality
from orderlens.schemas import RAW_ORDERS
from orderlens.sources import fixtures
from tests.conftest import SF_SMALL
from tests.test_load import _raw_row


def _raw(spark):
    rows = [_raw_row("a"), _raw_row("a"), _raw_row("b", amount=Decimal("-3.00")),
            _raw_row("c", amount=Decimal("2000.00"), customer_age_days=5, is_fraud=False),
            _raw_row("d", amount=Decimal("20.00"), is_fraud=True), _raw_row(None, customer_id=None)]
    return spark.createDataFrame(rows, RAW_ORDERS)


def test_warehouse_checks(spark):
    raw = _raw(spark)
    assert quality.check_row_counts(raw).first().passed
    nulls = quality.check_nulls(raw).first()
    assert (nulls.null_order_id, nulls.null_customer_id, nulls.passed) == (1, 1, False)
    assert [r.order_id for r in quality.check_duplicates(raw).collect()] == ["a"]
    assert quality.duplicate_sample(raw, 5).count() == 1
    ranges = quality.check_ranges(raw).first()
    assert ranges.negative_count == 1 and not ranges.passed
    fraud = quality.check_fraud_logic(raw, FraudRule()).first()
    assert (fraud.false_negatives, fraud.false_positives) == (1, 1)
    assert quality.check_partitions(raw).first().passed
    empty = raw.limit(0)
    assert not quality.check_row_counts(empty).first().passed
    assert quality.check_volume(raw, 100).first().row_count == 6
    assert quality.check_volume(raw, 3).count() == 0


def test_model_tests(spark):
    raw = _raw(spark)
    assert quality.test_unique(raw, "order_id").first().unique_field == "a"
    nn = quality.test_not_null(raw, ["order_id", "customer_id"])
    assert sorted(r.column_name for r in nn.collect()) == ["customer_id", "order_id"]
    assert quality.test_accepted_range(raw, "amount", 0, 1000).count() == 2
    stg = raw.withColumnRenamed("amount", "total_amount")
    # the AND form misses the false positive with age < 30 that the OR form catches
    assert quality.test_fraud_accuracy(stg, FraudRule()).count() == 1
    fresh = raw.withColumnRenamed("loaded_at", "processed_time")
    assert quality.test_freshness(fresh, dt.datetime(2024, 1, 2, 0, 30)).count() == 0
    assert quality.test_freshness(fresh, dt.datetime(2024, 1, 2, 2, 0)).count() == 6


def test_generator_rules(spark):
    df = spark.createDataFrame(
        [("o1", "c", 100.0, "books", 5, "t"), ("o2", "c", 30.0, "books", 0, "t"),
         ("o3", "c", 100.0, "toys", 5, "t"), ("o4", "c", 100.0, "electronics", 5, "t")],
        "order_id string, customer_id string, amount double, product_category string, "
        "customer_tenure_days int, timestamp string")
    assert {r.order_id for r in quality.test_accepted_values(df, "product_category").collect()} == {"o3"}
    got = {r.order_id: r.violation for r in quality.test_category_range(df).collect()}
    assert got == {"o1": "out_of_range", "o3": "unknown_category"}
    structure = {r.order_id: r.violation for r in quality.check_event_structure(df).collect()}
    assert structure == {"o2": "tenure_below_one"}
    broken = quality.check_event_structure(df.drop("timestamp"))
    assert broken.first().violation == "schema:timestamp"


def test_summary_counts_errors_as_failed(spark):
    raw = _raw(spark)
    checks = {
        "rows": lambda: quality.check_row_counts(raw),
        "dups": lambda: quality.check_duplicates(raw),
        "missing_column": lambda: quality.test_unique(raw, "no_such_column"),
        "runtime_error": lambda: raw.filter(F.raise_error(F.lit("boom")).isNull()),
    }
    lazy = {r.check: r for r in quality.quality_summary(spark, {k: v for k, v in checks.items()
                                                                if k != "runtime_error"}).collect()}
    assert lazy["rows"].passed and not lazy["dups"].passed and lazy["dups"].n_failed == 1
    assert lazy["missing_column"].passed is False and lazy["missing_column"].error
    eager = {r.check: r for r in quality.run_checks(spark, checks).collect()}
    assert eager["runtime_error"].passed is False and "boom" in eager["runtime_error"].error
    assert eager["rows"].passed


def test_fused_summary_equals_individual_checks(spark):
    from orderlens.plans.queries import warehouse_checks
    from orderlens.sources import fixtures
    from tests.conftest import SF_SMALL

    lazy = {r.check: (r.passed, r.n_failed) for r in
            quality.quality_summary(spark, warehouse_checks(spark, SF_SMALL)).collect()}
    raw = fixtures.raw_orders(spark, SF_SMALL)
    fused = {r.check: (r.passed, r.n_failed) for r in quality.warehouse_summary(raw, fixtures.F2_RULE).collect()}
    assert fused == lazy


def test_fused_summary_on_violating_rows(spark):
    from orderlens.operators.staging import stg_orders

    raw = _raw(spark).unionByName(spark.createDataFrame(
        [_raw_row("e", order_timestamp=None), _raw_row("f", amount=Decimal("20000.00"))], RAW_ORDERS))
    rule = FraudRule()
    fused = {r.check: r.n_failed for r in quality.warehouse_summary(raw, rule).collect()}
    stg = stg_orders(raw)
    individual = {
        "check_row_counts": quality.check_row_counts(raw).first().n_failed,
        "check_nulls": quality.check_nulls(raw).first().n_failed,
        "check_duplicates": quality.check_duplicates(raw).count(),
        "check_ranges": quality.check_ranges(raw).first().n_failed,
        "check_fraud_logic": quality.check_fraud_logic(raw, rule).first().n_failed,
        "check_partitions": quality.check_partitions(raw).first().n_failed,
        "test_unique_order_id": quality.test_unique(stg, "order_id").count(),
        "test_not_null_order_id": quality.test_not_null(stg, ["order_id", "total_amount", "order_date"]).count(),
        "test_accepted_range_total_amount": quality.test_accepted_range(stg, "total_amount", 0, 10000).count(),
        "test_fraud_accuracy": quality.test_fraud_accuracy(stg, rule).count(),
        "check_volume": quality.check_volume(stg, 100).count(),
    }
    assert fused == individual
    assert fused["check_duplicates"] == 1 and fused["check_nulls"] == 3 and fused["check_volume"] == 1


def test_missing_and_mistyped_columns_fail_their_checks_alone(spark):
    raw = fixtures.mixed_raw_orders(spark, SF_SMALL)
    whole = {r.check: r for r in quality.warehouse_summary(raw, fixtures.F2_RULE).collect()}
    broken = raw.drop("year").withColumn("is_fraud", F.col("is_fraud").cast("string"))
    for r in quality.warehouse_summary(broken, fixtures.F2_RULE).collect():
        lost = {"year", "is_fraud"} & quality.READS[r.check]
        if lost:
            assert not r.passed and r.n_failed is None and all(c in r.error for c in lost)
        else:
            assert (r.passed, r.n_failed, r.error) == (whole[r.check].passed, whole[r.check].n_failed, None)


def test_an_error_is_kept_whole(spark):
    def fails():
        raise ValueError("x" * 1000)

    row = quality.run_checks(spark, {"bad": fails}).first()
    assert not row.passed and len(row.error) > 1000


def test_failing_rows_agree_with_the_summary(spark):
    raw = fixtures.mixed_raw_orders(spark, SF_SMALL)
    summary = {r.check: r.n_failed for r in quality.warehouse_summary(raw, fixtures.F2_RULE).collect()}
    rows = quality.failing_rows(raw, fixtures.F2_RULE)
    for name in ("check_duplicates", "check_ranges", "check_fraud_logic"):
        assert rows[name]().count() == summary[name] > 0
    assert rows["check_nulls"]().count() > 0
