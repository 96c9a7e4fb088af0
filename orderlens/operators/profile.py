"""Profiles of the warehouse table: totals, counts, ranges, duplicates, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import round_ratio


def duplicate_keys(df: DataFrame, key: str = "order_id") -> DataFrame:
    """Keys occurring more than once, with their count (all of them)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def order_totals(raw: DataFrame) -> DataFrame:
    """The load verification totals in one pass (one row)."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("order_id").alias("distinct_orders"),
        F.countDistinct("customer_id").alias("distinct_customers"),
        F.count_if(F.col("is_fraud")).alias("fraud_orders"),
        F.round(F.sum("amount"), 2).alias("total_revenue"),
        round_ratio(F.sum("amount"), F.count("amount")).alias("avg_order_value"),
        F.to_date(F.min("order_timestamp")).alias("earliest"),
        F.to_date(F.max("order_timestamp")).alias("latest"),
    )


def category_counts(raw: DataFrame, category: str = "category") -> DataFrame:
    """A10."""
    return raw.groupBy(category).agg(F.count(F.lit(1)).alias("order_count"))


def partition_profile(raw: DataFrame) -> DataFrame:
    """Distinct years, months and days."""
    return raw.agg(F.countDistinct("year").alias("years"), F.countDistinct("month").alias("months"),
                   F.countDistinct("day").alias("days"))


def null_counts(raw: DataFrame, columns=("order_id", "customer_id", "amount", "order_timestamp"),
                names=("null_order_id", "null_customer_id", "null_amount", "null_timestamp")) -> DataFrame:
    """NULLs per column, one pass."""
    return raw.agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(columns, names)])


def row_count_below(df: DataFrame, min_rows: int) -> DataFrame:
    """`SELECT count(*) ... HAVING count(*) < min_rows` (no GROUP BY)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") < min_rows)


def latest_orders(raw: DataFrame, n: int = 5) -> DataFrame:
    """The newest N orders (top-k, not a full sort)."""
    return raw.orderBy(F.col("order_timestamp").desc(), "order_id", "product_id", "amount").limit(n).select(
        "order_id", "category", "product_name", "amount", "is_fraud", "order_timestamp")
