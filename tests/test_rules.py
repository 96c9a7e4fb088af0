"""Fraud rule, validation and decoding on the reference's literal rows and edge rows."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from orderlens.config import FraudRule
from orderlens.operators.decode import decode_orders
from orderlens.operators.rules import flag_fraud, fraud_orders, route, valid_orders
from orderlens.operators.validate import validate_orders

RULE = FraudRule()


def _orders(spark, rows):
    return spark.createDataFrame(
        [Row(order_id=o, customer_id=f"c-{o}", amount=a, customer_tenure_days=t) for o, a, t in rows],
        "order_id string, customer_id string, amount double, customer_tenure_days int")


def test_fraud_rule_splits_literal_rows(spark):
    # Literal rows of the rule's definition.
    rows = [("ord-1", 50.0, 100), ("ord-2", 500.0, 200), ("ord-3", 100.0, 10),
            ("ord-4", 1500.0, 5), ("ord-5", 2000.0, 25), ("ord-6", 1001.0, 29)]
    flagged = flag_fraud(_orders(spark, rows), RULE)
    fraud = {r.order_id for r in fraud_orders(flagged).collect()}
    valid = {r.order_id for r in valid_orders(flagged).collect()}
    assert fraud == {"ord-4", "ord-5", "ord-6"}
    assert valid == {"ord-1", "ord-2", "ord-3"}


@pytest.mark.parametrize("amount,tenure", [(1000.0, 10), (1500.0, 30)])
def test_thresholds_are_strict(spark, amount, tenure):
    flagged = flag_fraud(_orders(spark, [("ord-edge", amount, tenure)]), RULE)
    assert flagged.first().is_fraud is False


def test_fraud_reason_text(spark):
    # Fixed value: the reason text.
    flagged = flag_fraud(_orders(spark, [("a", 1500.0, 5), ("b", 5.0, 5)]), RULE)
    got = {r.order_id: r.fraud_reason for r in flagged.collect()}
    assert got["a"] == "High value order (>$1000.0) from new customer (<30 days)"
    assert got["b"] is None


def test_null_inputs_are_not_fraud(spark):
    df = spark.createDataFrame([("x", None, 5), ("y", 5000.0, None)],
                               "order_id string, amount double, customer_tenure_days int")
    assert [r.is_fraud for r in flag_fraud(df, RULE).collect()] == [False, False]


def test_routing_is_disjoint_and_complete(spark):
    rows = [(f"o{i}", float(i * 137 % 3000), i % 60) for i in range(200)]
    flagged = flag_fraud(_orders(spark, rows), RULE)
    fraud, valid = route(flagged)
    assert fraud.count() + valid.count() == 200
    assert fraud.join(valid, "order_id").count() == 0
    assert flagged.exceptAll(fraud.unionByName(valid)).count() == 0


def _records(spark, payloads):
    return spark.createDataFrame(
        [(p.encode() if p is not None else None,) for p in payloads], "value binary"
    ).withColumn("timestamp", F.current_timestamp())


def _event(**kw):
    base = {"order_id": "ord-1", "customer_id": "c-1", "amount": 100.0, "currency": "USD",
            "product_category": "books", "customer_tenure_days": 50,
            "timestamp": "2024-01-01T10:00:00", "event_type": "order_created"}
    base.update(kw)
    return json.dumps(base)


def test_validation_drops_bad_amounts_and_tenures(spark):
    # Literal rows of the validity rule's definition.
    recs = _records(spark, [_event(order_id="ord-1", amount=100.0), _event(order_id="ord-2", amount=-50.0),
                            _event(order_id="ord-3", amount=0.0)])
    assert [r.order_id for r in validate_orders(decode_orders(recs)).collect()] == ["ord-1"]
    recs = _records(spark, [_event(order_id="ord-1", customer_tenure_days=50),
                            _event(order_id="ord-2", customer_tenure_days=-10)])
    assert [r.order_id for r in validate_orders(decode_orders(recs)).collect()] == ["ord-1"]


def test_decode_edge_rows(spark):
    payloads = [
        "{bad",                                        # unparsable -> all NULL -> rejected
        json.dumps({"order_id": "x", "amount": "x"}),  # bad field -> NULL amount -> rejected
        _event(order_id="ts-bad", timestamp="garbage"),  # NULL event time -> rejected
        _event(order_id=None),                         # NULL key -> rejected
        _event(order_id="ten-null", customer_tenure_days=None),  # NULL tenure -> rejected
        _event(order_id="ten-zero", customer_tenure_days=0),     # tenure 0 kept
    ]
    decoded = decode_orders(_records(spark, payloads))
    assert decoded.count() == 6
    rows = decoded.collect()
    assert rows[0].order_id is None and rows[0].amount is None
    assert rows[1].order_id == "x" and rows[1].amount is None
    assert rows[2].event_time is None
    kept = [r.order_id for r in validate_orders(decoded).collect()]
    assert kept == ["ten-zero"]


def test_decode_keeps_microseconds_and_broker_time(spark):
    recs = _records(spark, [_event(timestamp="2024-01-01T00:00:07.179575")])
    row = decode_orders(recs).first()
    assert row.event_time.microsecond == 179575
    assert row.kafka_timestamp is not None


def test_amounts_that_are_not_finite_are_rejected_with_a_reason(spark):
    """from_json accepts a bare NaN or Infinity and both are > 0; no sum could hold them, so they are no valid orders."""
    from orderlens.operators.validate import rejected_orders

    event = '{"order_id":"%s","customer_id":"c","amount":%s,"customer_tenure_days":5,"timestamp":"2024-01-01T00:00:00"}'
    recs = _records(spark, [event % x for x in (("n", "NaN"), ("i", "Infinity"), ("z", "0"), ("ok", "1e11"))])
    decoded = decode_orders(recs)
    assert [r.order_id for r in validate_orders(decoded).collect()] == ["ok"]
    assert {r.order_id: r.reject_reason for r in rejected_orders(decoded).collect()} == {
        "n": "amount_not_finite", "i": "amount_not_finite", "z": "amount_not_positive"}
    assert flag_fraud(validate_orders(decoded), RULE).first().is_fraud is True
