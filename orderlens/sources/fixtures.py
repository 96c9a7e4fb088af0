"""Order-shaped inputs derived by Spark from the given tables.

F1 (`order_events`): one stream event per row of `events`.
F2 (`raw_orders`): the warehouse table `raw.orders`, one row per line item
of `lineitem JOIN orders JOIN part`.

Both are plain lazy plans over the source tables, so every query built on
them scales with those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import CATEGORIES, FraudRule
from orderlens.functions import date_parts, fraud_flag, fraud_reason
from orderlens.schemas import ORDER_EVENT, RAW_ORDERS
from orderlens.sources.tables import table

# Fixed values of the fixtures.
F1_RULE = FraudRule(amount_threshold=100.0, tenure_days=30)
F2_RULE = FraudRule(amount_threshold=80000.0, tenure_days=30)
F2_LOADED_AT = "1999-01-01 00:00:00"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TOPIC_PARTITIONS = 3


def _event_columns() -> list:
    return [
        F.concat(F.lit("ord-"), F.col("event_id").cast("string")).alias("order_id"),
        F.concat(F.lit("cust-"), F.col("user_id").cast("string")).alias("customer_id"),
        F.col("value").cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("event_type").alias("product_category"),
        F.from_json(F.col("props"), "k INT").getField("k").alias("customer_tenure_days"),
        F.lit(None).cast("string").alias("customer_email"),
        F.lit(None).cast("string").alias("customer_country"),
        F.date_format(F.col("ts"), ISO_MICROS).alias("timestamp"),
        F.lit("order_created").alias("event_type"),
    ]


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stream-shaped order events (the 10 fields of the JSON payload)."""
    df = table(spark, sf_dir, "events").select(*_event_columns())
    return df.select([F.col(f.name).cast(f.dataType) for f in ORDER_EVENT.fields])


def order_topic(spark: SparkSession, sf_dir: str, topic: str = "orders.raw") -> DataFrame:
    """F1 as topic records: key = customer_id, value = JSON of the event.

    The broker timestamp is the event time, which keeps the fixture
    deterministic; offsets are the source event ids (unique, increasing).
    One projection over `events`, no shuffle.
    """
    ev = table(spark, sf_dir, "events")
    payload = F.struct(*[c.cast(f.dataType).alias(f.name)
                         for c, f in zip(_event_columns(), ORDER_EVENT.fields)])
    cust = F.concat(F.lit("cust-"), F.col("user_id").cast("string"))
    return ev.select(
        cust.cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(cust), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def raw_orders(spark: SparkSession, sf_dir: str, rule: FraudRule = F2_RULE,
               loaded_at: str = F2_LOADED_AT) -> DataFrame:
    """the warehouse table raw.orders (17 declared columns)."""
    return _raw_lines(spark, sf_dir, rule, loaded_at).select(*RAW_ORDERS.fieldNames())


def _raw_lines(spark: SparkSession, sf_dir: str, rule: FraudRule, loaded_at: str) -> DataFrame:
    """The columns of raw.orders with the order key and line number they come from."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    j = li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).join(
        pt, F.col("l_partkey") == F.col("p_partkey"))
    ts = (F.col("o_orderdate").cast("timestamp")
          + F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"), F.lit(0), F.lit(0)))
    base = j.select(
        "l_orderkey", "l_linenumber",
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        ts.alias("order_timestamp"),
        (F.col("o_custkey") % 120).cast("int").alias("customer_age_days"),
    )
    flagged = base.withColumn(
        "is_fraud", fraud_flag(rule, "amount", "customer_age_days")
    ).withColumn("fraud_reason", fraud_reason(rule))
    out = flagged.select(
        "*", *date_parts("order_timestamp"),
        F.to_timestamp(F.lit(loaded_at)).alias("loaded_at"),
        F.lit(None).cast("string").alias("source_file"),
    )
    return out.select("l_orderkey", "l_linenumber", *[F.col(f.name).cast(f.dataType) for f in RAW_ORDERS.fields])


# --- inputs with bad rows -----------------------------------------------------
# Rules that break a fixed share of the rows, by the row's key; the SQL twins
# apply the same ones. Modulus and cases are fixed values of the fixtures.

MIXED_EVENTS = 50
MIXED_RAW = 60


def mixed_topic(spark: SparkSession, sf_dir: str, topic: str = "orders.raw") -> DataFrame:
    """F1 as topic records, some of them bad (by event_id modulo MIXED_EVENTS).

    1 broken JSON, 2 bad timestamp, 3 negative amount, 4 negative tenure, 5 no
    customer, 6 no order id, 7 no amount, 8-17 a known category, 21 amount 0,
    22 no tenure, 23 NaN, 24 Infinity, 25 an amount of 1e11.
    """
    m = F.col("event_id") % MIXED_EVENTS
    changed = {
        "order_id": {6: F.lit(None)},
        "customer_id": {5: F.lit(None)},
        "amount": {3: -F.col("value"), 7: F.lit(None), 21: F.lit(0.0), 23: F.lit(float("nan")),
                   24: F.lit(float("inf")), 25: F.lit(1e11)},
        "customer_tenure_days": {4: F.lit(-1), 22: F.lit(None)},
        "timestamp": {2: F.lit("not a time")},
        "product_category": {8 + i: F.lit(CATEGORIES[i % len(CATEGORIES)]) for i in range(10)},
    }
    fields = []
    for c, f in zip(_event_columns(), ORDER_EVENT.fields):
        col = c.cast(f.dataType)
        for k, v in changed.get(f.name, {}).items():
            col = F.when(m == k, v.cast(f.dataType)).otherwise(col)
        fields.append(col.alias(f.name))
    value = F.when(m == 1, F.lit('{"order_id": broken')).otherwise(F.to_json(F.struct(*fields)))
    cust = F.concat(F.lit("cust-"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        cust.cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(cust), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"))


def mixed_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 with bad rows (by 7 * order key + line, modulo MIXED_RAW).

    1 no order id, 2 no customer, 3 no amount, 4 no time, 5 negative amount,
    6 quantity 0, 7 wrong fraud flag, 8 loaded a day earlier, 9 no product,
    10 negative age, 11 an amount too wide for staging, 12 negative price,
    13 a category over its width; the rows of 20 come twice.

    The number is taken from the keys themselves: every filter over these rows
    repeats it in each column it reads, so it must cost next to nothing.
    """
    raw = _raw_lines(spark, sf_dir, F2_RULE, F2_LOADED_AT)
    keyed = raw.withColumn("_k", (F.col("l_orderkey").cast("long") * 7 + F.col("l_linenumber").cast("long")) % MIXED_RAW)
    changed = {
        "order_id": {1: F.lit(None)}, "customer_id": {2: F.lit(None)}, "product_id": {9: F.lit(None)},
        "amount": {3: F.lit(None), 5: -F.col("amount"), 11: F.col("amount") + F.lit(2_000_000_000)},
        "order_timestamp": {4: F.lit(None)}, "quantity": {6: F.lit(0)}, "is_fraud": {7: ~F.col("is_fraud")},
        "loaded_at": {8: F.to_timestamp(F.lit("1998-12-30 00:00:00"))}, "customer_age_days": {10: F.lit(-1)},
        "price": {12: -F.col("price")}, "category": {13: F.repeat(F.lit("x"), F.lit(101))},
    }
    columns = []
    for f in RAW_ORDERS.fields:
        col = F.col(f.name)
        for k, v in changed.get(f.name, {}).items():
            col = F.when(F.col("_k") == k, v.cast(f.dataType)).otherwise(col)
        columns.append(col.alias(f.name))
    twice = F.explode(F.when(F.col("_k") == 20, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return keyed.select("*", twice.alias("_copy")).select(*columns)
