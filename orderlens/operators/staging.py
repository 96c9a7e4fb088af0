"""Staging models: cleaned orders and per-customer summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import customer_segment, pg_day_of_week, round_ratio
from orderlens.operators.conform import to_staging_source
from orderlens.schemas import STG_ORDERS


def staging_columns() -> list:
    """The 13 staging columns as expressions over the staging source names."""
    return [F.col(name).try_cast(typ).alias(name) for name, typ in STG_ORDERS] + [
        F.to_date(F.col("order_timestamp")).alias("order_date"),
        F.hour(F.col("order_timestamp")).cast("int").alias("order_hour"),
        pg_day_of_week("order_timestamp").alias("order_day_of_week"),
    ]


STAGING_NAMES = [name for name, _ in STG_ORDERS] + ["order_date", "order_hour", "order_day_of_week"]


def fits():
    """Whether every source value fits its staging type (a NULL does)."""
    ok = F.lit(True)
    for name, typ in STG_ORDERS:
        if typ.startswith(("decimal", "int")):
            ok = ok & (F.col(name).isNull() | F.col(name).try_cast(typ).isNotNull())
    return ok


def staging_rejects(raw: DataFrame) -> DataFrame:
    """Rows with a value that does not fit its staging type (P13), as they are in raw.orders, with its names."""
    src = to_staging_source(raw)
    lost = [F.when(F.col(name).isNotNull() & F.col(name).try_cast(typ).isNull(), F.lit(f"{name}_unfit"))
            for name, typ in STG_ORDERS if typ.startswith(("decimal", "int"))]
    return src.select("*", F.concat_ws(",", *lost).alias("violations")).filter(F.col("violations") != "")


def stg_orders(raw: DataFrame) -> DataFrame:
    """Raw.orders -> staging orders.

    Drops rows without order_timestamp (pushed to the scan) and rows with a
    value that does not fit (see `staging_rejects`), casts the ten source
    columns, derives order_date / order_hour / order_day_of_week
    (0 = Sunday) and removes exact duplicate rows. The de-duplication is a
    hash aggregate with map-side combine, so a hot group of identical rows
    collapses before the shuffle.
    """
    src = to_staging_source(raw).filter(F.col("order_timestamp").isNotNull() & fits())
    return src.select(*staging_columns()).distinct()


def customer_summary_aggs() -> list:
    """Per-customer aggregates shared by the customer models."""
    return [
        F.min("order_timestamp").alias("first_order_date"),
        F.max("order_timestamp").alias("last_order_date"),
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("total_amount").alias("_amount_sum"),
        F.count("total_amount").alias("_amount_n"),
        F.max("customer_age_days").alias("current_age_days"),
    ]


def stg_customers(stg: DataFrame) -> DataFrame:
    """Per-customer summary with segment.

    The single distinct count is planned as a (customer_id, order_id)
    shuffle followed by a per-customer merge, so one very large customer is
    spread over many tasks instead of landing in one.
    """
    agg = stg.groupBy("customer_id").agg(*customer_summary_aggs())
    return agg.select(
        "customer_id",
        "first_order_date",
        "last_order_date",
        "total_orders",
        F.round(F.col("_amount_sum"), 2).alias("lifetime_value"),
        round_ratio("_amount_sum", "_amount_n").alias("avg_order_value"),
        "current_age_days",
        customer_segment("current_age_days").alias("customer_segment"),
    )
