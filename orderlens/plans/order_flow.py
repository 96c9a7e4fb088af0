"""The order pipeline composed from the operators (batch and stream alike).

topic records -> decode -> validate -> flag -> route; the same functions
serve a bounded read and a streaming read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderlens.config import FraudRule
from orderlens.operators.conform import with_partition_columns
from orderlens.operators.decode import decode_orders
from orderlens.operators.rules import flag_fraud, fraud_orders, valid_orders
from orderlens.operators.validate import validate_orders


def clean_orders(records: DataFrame) -> DataFrame:
    return validate_orders(decode_orders(records))


def flagged_orders(records: DataFrame, rule: FraudRule) -> DataFrame:
    return flag_fraud(clean_orders(records), rule)


def lake_rows(records: DataFrame, rule: FraudRule) -> DataFrame:
    """Valid (non-fraud) orders with their year/month/day partition columns."""
    return with_partition_columns(valid_orders(flagged_orders(records, rule)), "event_time")


def alert_rows(records: DataFrame, rule: FraudRule) -> DataFrame:
    return fraud_orders(flagged_orders(records, rule))
