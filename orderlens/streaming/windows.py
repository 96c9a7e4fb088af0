"""Tumbling-window revenue per category, one definition for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULT_WINDOW, WindowSpec
from orderlens.functions import exact_money, exact_money_sum, to_double


def window_revenue(clean: DataFrame, spec: WindowSpec = DEFAULT_WINDOW,
                   ts: str = "event_time", category: str = "product_category") -> DataFrame:
    """Sum / count / avg of amount per (window, category) over all clean orders.

    On a stream the event-time watermark bounds the state: a window is
    dropped from state once its end passes max(event_time) - delay, and rows
    of such windows arriving later are discarded. The sum is an exact
    decimal, so the result does not depend on batch boundaries or on how
    rows are spread over tasks. Partial aggregation happens before the
    shuffle, so a hot category costs one row per task and window.
    """
    src = clean.withWatermark(ts, spec.watermark) if clean.isStreaming else clean
    agg = src.groupBy(F.window(F.col(ts), spec.window).alias("window"), F.col(category)).agg(
        exact_money_sum("amount").alias("_sum"),
        F.count(F.lit(1)).alias("order_count"),
        F.count(exact_money("amount")).alias("_n"),
    )
    return agg.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        category,
        to_double("_sum").alias("total_revenue"),
        "order_count",
        (to_double("_sum") / F.nullif(F.col("_n"), F.lit(0))).alias("avg_order_value"),
    )


def latest_per_window(updates: DataFrame, keys=("window_start", "product_category"),
                      order: str = "batch_id") -> DataFrame:
    """Final state from an update-mode log: the last emitted row per key.

    A `max` of a struct leading with the batch id (map-side partial) rather
    than a window function, so a key updated in many batches does not
    gather in one task.
    """
    value_cols = [c for c in updates.columns if c not in keys and c != order]
    latest = updates.groupBy(*keys).agg(F.max(F.struct(order, *value_cols)).alias("_last"))
    return latest.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in value_cols])
