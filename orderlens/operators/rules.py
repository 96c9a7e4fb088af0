"""Fraud rule and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULT_RULE, FraudRule
from orderlens.functions import fraud_flag, fraud_reason


def flag_fraud(orders: DataFrame, rule: FraudRule = DEFAULT_RULE,
               amount: str = "amount", tenure: str = "customer_tenure_days") -> DataFrame:
    """Add is_fraud (strict thresholds, NULL -> False) and fraud_reason."""
    return orders.withColumn("is_fraud", fraud_flag(rule, amount, tenure)).withColumn(
        "fraud_reason", fraud_reason(rule))


def fraud_orders(flagged: DataFrame) -> DataFrame:
    """Fraud rows only (NULL flags dropped)."""
    return flagged.filter(F.col("is_fraud"))


def valid_orders(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_fraud"))


def route(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into two disjoint streams (fraud, valid) that cover the input."""
    return fraud_orders(flagged), valid_orders(flagged)
