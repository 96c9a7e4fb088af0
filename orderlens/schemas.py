"""Declared schemas of the three shapes one order takes, and the name maps.

Stream events are decoded with a fixed schema (never inferred); warehouse and
staging shapes are declared as in the warehouse DDL.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The order event as published on the input topic (JSON value).
ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("currency", T.StringType(), True),
    T.StructField("product_category", T.StringType(), True),
    T.StructField("customer_tenure_days", T.IntegerType(), False),
    T.StructField("customer_email", T.StringType(), True),
    T.StructField("customer_country", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("event_type", T.StringType(), True),
])

# Rows of a topic read (the columns a Kafka source produces).
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Warehouse table raw.orders. Every field is declared nullable: Parquet
# tables do not enforce NOT NULL, and a non-nullable declaration would let
# the optimizer fold `IS NULL` tests away. The declared NOT NULL columns
# are enforced by the constraint gate instead.
RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.StringType(), True),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("price", T.DecimalType(10, 2), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("amount", T.DecimalType(12, 2), True),
    T.StructField("order_timestamp", T.TimestampType(), True),
    T.StructField("customer_age_days", T.IntegerType(), True),
    T.StructField("is_fraud", T.BooleanType(), True),
    T.StructField("fraud_reason", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
    T.StructField("loaded_at", T.TimestampType(), True),
    T.StructField("source_file", T.StringType(), True),
])

# The 16 columns the loader writes (loaded_at comes from the table default).
LOAD_COLUMNS = [f.name for f in RAW_ORDERS.fields if f.name != "loaded_at"]

# Stream / lake names -> warehouse names.
STREAM_TO_WAREHOUSE = {
    "product_category": "category",
    "customer_tenure_days": "customer_age_days",
    "event_time": "order_timestamp",
}

# Warehouse names -> staging source names.
WAREHOUSE_TO_STAGING = {
    "amount": "total_amount",
    "loaded_at": "processed_time",
}

# Staging model columns and types, in model order. The VARCHAR(50) width of
# the key columns is enforced when rows enter raw.orders (constraint gate).
STG_ORDERS = [
    ("order_id", "string"),
    ("customer_id", "string"),
    ("product_id", "string"),
    ("quantity", "int"),
    ("price", "decimal(10,2)"),
    ("total_amount", "decimal(10,2)"),
    ("order_timestamp", "timestamp"),
    ("customer_age_days", "int"),
    ("is_fraud", "boolean"),
    ("processed_time", "timestamp"),
]


# Declared warehouse tables beyond raw.orders (constraints live in the gate).
STAGING_ORDERS_TABLE = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("amount", T.DecimalType(12, 2)),
    T.StructField("order_timestamp", T.TimestampType()),
    T.StructField("customer_age_days", T.IntegerType()),
    T.StructField("is_fraud", T.BooleanType()),
    T.StructField("fraud_reason", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

DAILY_REVENUE_TABLE = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("total_orders", T.IntegerType()),
    T.StructField("total_revenue", T.DecimalType(15, 2)),
    T.StructField("avg_order_value", T.DecimalType(10, 2)),
    T.StructField("fraud_orders", T.IntegerType()),
    T.StructField("fraud_amount", T.DecimalType(15, 2)),
    T.StructField("created_at", T.TimestampType()),
])

CUSTOMER_METRICS_TABLE = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_order_date", T.DateType()),
    T.StructField("last_order_date", T.DateType()),
    T.StructField("total_orders", T.IntegerType()),
    T.StructField("total_spent", T.DecimalType(15, 2)),
    T.StructField("avg_order_value", T.DecimalType(10, 2)),
    T.StructField("is_high_value", T.BooleanType()),
    T.StructField("fraud_orders", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE from a StructType."""
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
        for f in schema.fields
    )
