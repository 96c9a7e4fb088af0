"""Decode topic records into typed order events (payload -> struct -> columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.schemas import ORDER_EVENT


def decode_orders(records: DataFrame, schema=ORDER_EVENT) -> DataFrame:
    """Binary value -> JSON string -> struct -> 10 columns + kafka_timestamp + event_time.

    Bad JSON gives an all-NULL row, a badly typed field gives NULL in that
    field; an unparsable timestamp gives a NULL event_time (try_to_timestamp,
    since to_timestamp raises under ANSI). Validation drops such rows.

    The struct is expanded with inline(array(...)), one output row per
    record: predicates on the decoded fields then stay above the expansion,
    so each payload is parsed once. (Expanding with `data.*` lets the
    optimizer substitute the parse into every pushed-down predicate.)
    """
    payload = F.struct(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    decoded = records.select(F.inline(F.array(payload))).select("data.*", "kafka_timestamp")
    return decoded.withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))
