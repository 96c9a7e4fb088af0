"""Validity filter of decoded orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the reasons, in the order in which they are tested.
REASONS = ("amount_not_positive", "amount_not_finite", "tenure_negative", "no_event_time", "no_order_id", "no_customer_id")


def _rules() -> list[Column]:
    """What a valid order fulfils, in the order of REASONS."""
    amount = F.col("amount")
    return [
        amount > 0,  # NaN and Infinity pass it
        ~F.isnan(amount) & (F.abs(amount) < F.lit(float("inf"))),
        F.col("customer_tenure_days") >= 0,
        F.col("event_time").isNotNull(),
        F.col("order_id").isNotNull(),
        F.col("customer_id").isNotNull(),
    ]


def validate_orders(orders: DataFrame) -> DataFrame:
    """Keep finite amount > 0, tenure >= 0 and non-NULL event_time, order_id, customer_id.

    One conjunctive predicate; Catalyst pushes it into the scan where the
    columns are stored.
    """
    keep = F.lit(True)
    for rule in _rules():
        keep = keep & rule
    return orders.filter(keep)


def rejected_orders(orders: DataFrame) -> DataFrame:
    """The orders that `validate_orders` drops, with the first rule they break as `reject_reason`."""
    reason = F.coalesce(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in zip(REASONS, _rules())])
    return orders.select("*", reason.alias("reject_reason")).filter(F.col("reject_reason").isNotNull())
