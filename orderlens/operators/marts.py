"""Intermediate and mart models: customer 360, daily revenue, fraud patterns,
hourly rollup, and the declared analytics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import (
    customer_segment,
    rate_pct,
    risk_category,
    round_ratio,
    time_of_day,
    to_double,
)
from orderlens.operators.staging import customer_summary_aggs


def customer_360(stg: DataFrame) -> DataFrame:
    """Per customer: segment, lifetime value, orders, fraud orders, fraud rate, risk.

    Orders LEFT JOIN their own per-customer summary, grouped by customer and
    the summary columns, is one aggregation by customer_id: every summary
    column is a function of the key. So no join and a single (skew-safe)
    aggregate. Orders with a NULL customer match no summary row, so their
    summary columns are NULL, as with the join.
    """
    agg = stg.groupBy("customer_id").agg(
        F.max("customer_age_days").alias("_age"),
        F.sum("total_amount").alias("_ltv"),
        F.countDistinct("order_id").alias("_orders"),
        F.count_if(F.col("is_fraud")).alias("fraud_orders"),
        F.count(F.lit(1)).alias("_rows"),
    )
    known = F.col("customer_id").isNotNull()
    rate = rate_pct("fraud_orders", "_rows")
    return agg.select(
        "customer_id",
        F.when(known, customer_segment("_age")).alias("customer_segment"),
        F.when(known, F.round(F.col("_ltv"), 2)).alias("lifetime_value"),
        F.when(known, F.col("_orders")).alias("total_orders"),
        "fraud_orders",
        rate.alias("fraud_rate_pct"),
        risk_category(rate).alias("risk_category"),
    )


def _daily_base(stg: DataFrame) -> DataFrame:
    fraud_amount = F.when(F.col("is_fraud"), F.col("total_amount")).otherwise(F.lit(0))
    return stg.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum("total_amount").alias("total_revenue"),
        F.count("total_amount").alias("_amount_n"),
        F.sum(fraud_amount).alias("fraud_revenue"),
        F.count_if(F.col("is_fraud")).alias("fraud_orders"),
    )


def daily_revenue(stg: DataFrame) -> DataFrame:
    """Revenue per order date, newest first.

    avg_order_value is per row (not per distinct order); fraud revenue is 0
    on a day without fraud.
    """
    base = _daily_base(stg)
    return base.select(
        "order_date",
        "total_orders",
        "unique_customers",
        "total_revenue",
        (to_double("total_revenue") / F.nullif(F.col("_amount_n"), F.lit(0))).alias("avg_order_value"),
        "fraud_revenue",
        "fraud_orders",
        round_ratio(F.col("fraud_revenue") * F.lit(100), F.col("total_revenue")).alias("fraud_revenue_pct"),
    ).orderBy(F.col("order_date").desc())


def daily_revenue_contract(stg: DataFrame) -> DataFrame:
    """The declared analytics.daily_revenue table, as a projection of the mart."""
    base = _daily_base(stg)
    return base.select(
        F.col("order_date").alias("date"),
        F.col("total_orders").cast("int").alias("total_orders"),
        F.col("total_revenue").cast("decimal(15,2)").alias("total_revenue"),
        round_ratio("total_revenue", "_amount_n").cast("decimal(10,2)").alias("avg_order_value"),
        F.col("fraud_orders").cast("int").alias("fraud_orders"),
        F.col("fraud_revenue").cast("decimal(15,2)").alias("fraud_amount"),
    )


def fraud_analysis(stg: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Fraud patterns by date x hour x customer segment.

    The fraud filter comes first: only fraud rows are aggregated by
    (customer, date, hour) and joined with their customer's segment, so the
    planner can broadcast or split that side. The segment depends on all of a
    customer's orders: it is taken from the customer summary (`customers`),
    else from one map-side combined max per customer. Orders without a
    customer get a NULL segment, as with the left join.
    """
    amount, age = F.col("total_amount"), F.col("customer_age_days")
    partial = stg.filter(F.col("is_fraud")).groupBy("customer_id", "order_date", "order_hour").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_sum"), F.count(amount).alias("_cnt"),
        F.min(age).alias("_min_age"), F.max(age).alias("_max_age"))
    if customers is None:
        customers = stg.groupBy("customer_id").agg(customer_segment(F.max(age)).alias("customer_segment"))
    joined = partial.join(customers.select("customer_id", "customer_segment"), "customer_id", "left")
    out = joined.groupBy("order_date", "order_hour", "customer_segment").agg(
        F.sum("_n").alias("fraud_count"),
        round_ratio(F.sum("_sum"), F.sum("_cnt")).alias("avg_fraud_amount"),
        F.min("_min_age").alias("min_customer_age"),
        F.max("_max_age").alias("max_customer_age"),
    )
    return out.select("*", time_of_day("order_hour").alias("time_of_day")).orderBy(
        F.col("fraud_count").desc(), "order_date", "order_hour", "customer_segment")


def hourly_metrics(raw: DataFrame) -> DataFrame:
    """A6 (refreshed as a table by K9): hourly rollup of raw.orders; fraud_amount is NULL without fraud."""
    fraud = F.col("is_fraud")
    agg = raw.groupBy(F.date_trunc("hour", F.col("order_timestamp")).alias("hour")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("amount").alias("total_revenue"),
        F.count("amount").alias("_amount_n"),
        F.count_if(fraud).alias("fraud_count"),
        F.sum(F.when(fraud, F.col("amount"))).alias("fraud_amount"),
    )
    return agg.select(
        "hour", "order_count", "total_revenue",
        (to_double("total_revenue") / F.nullif(F.col("_amount_n"), F.lit(0))).alias("avg_order_value"),
        "fraud_count", "fraud_amount",
    )


def customer_metrics_contract(stg: DataFrame, high_value_threshold: float) -> DataFrame:
    """The declared analytics.customer_metrics table (summary joined with fraud counts).

    Both halves group by customer_id, so they are one aggregation. The table
    key is NOT NULL, so orders without a customer are left out.
    `is_high_value` = total_spent > high_value_threshold (a caller parameter).
    """
    agg = stg.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        *customer_summary_aggs(), F.count_if(F.col("is_fraud")).alias("_fraud"))
    spent = F.round(F.col("_amount_sum"), 2)
    return agg.select(
        "customer_id",
        F.to_date("first_order_date").alias("first_order_date"),
        F.to_date("last_order_date").alias("last_order_date"),
        F.col("total_orders").cast("int").alias("total_orders"),
        spent.cast("decimal(15,2)").alias("total_spent"),
        round_ratio("_amount_sum", "_amount_n").cast("decimal(10,2)").alias("avg_order_value"),
        (spent > F.lit(high_value_threshold)).alias("is_high_value"),
        F.col("_fraud").cast("int").alias("fraud_orders"),
    )
