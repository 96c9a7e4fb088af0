"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the given tables (through the fixtures) so its work grows with
them, and returns the operator's result at the output edge.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import conform, load, marts, profile, quality, rules, staging
from orderlens.operators.decode import decode_orders
from orderlens.operators.validate import rejected_orders, validate_orders
from orderlens.plans import order_flow
from orderlens.plans.edge import edge
from orderlens.plans import sql_models
from orderlens.plans.load_job import file_totals, load_lake, load_new_files
from orderlens.schemas import ORDER_EVENT
from orderlens.session import scratch_path
from orderlens.sinks import writers
from orderlens.sources import fixtures
from orderlens.sources.files import scan_range, scan_valid
from orderlens.sources.store import put_text
from orderlens.sources.topic import file_topic_stream, peek_messages, stage_topic
from orderlens.sources.topic_log import append_topic, drain, size, topic_records, topic_stream
from orderlens.streaming import fanout, pipeline
from orderlens.streaming.state import large_state, open_windows, quick_checkpoints
from orderlens.streaming.windows import window_revenue

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed values of the registered queries.
HIGH_VALUE_THRESHOLD = 1_000_000.0


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: edge(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


def _stg(spark, sf_dir):
    return staging.stg_orders(fixtures.raw_orders(spark, sf_dir))


# --- staging and marts -----------------------------------------------------

@register("stg_orders")
def q_stg_orders(spark, sf_dir):
    return _stg(spark, sf_dir)


@register("stg_customers")
def q_stg_customers(spark, sf_dir):
    return staging.stg_customers(_stg(spark, sf_dir))


@register("customer_360")
def q_customer_360(spark, sf_dir):
    return marts.customer_360(_stg(spark, sf_dir))


@register("daily_revenue")
def q_daily_revenue(spark, sf_dir):
    return marts.daily_revenue(_stg(spark, sf_dir))


@register("fraud_analysis")
def q_fraud_analysis(spark, sf_dir):
    return marts.fraud_analysis(_stg(spark, sf_dir))


@register("hourly_metrics")
def q_hourly_metrics(spark, sf_dir):
    return marts.hourly_metrics(fixtures.raw_orders(spark, sf_dir))


@register("daily_revenue_contract")
def q_daily_revenue_contract(spark, sf_dir):
    return marts.daily_revenue_contract(_stg(spark, sf_dir))


@register("customer_metrics_contract")
def q_customer_metrics_contract(spark, sf_dir):
    return marts.customer_metrics_contract(_stg(spark, sf_dir), HIGH_VALUE_THRESHOLD)


# --- stream-shaped orders (F1) ------------------------------------------------

F1_RULE = fixtures.F1_RULE
F2_RULE = fixtures.F2_RULE
# Fixed values of the registered queries: time range of the pruned scan,
# freshness reference time (30 minutes after the fixture's load time).
RANGE_START = _dt.datetime(2024, 1, 10)
RANGE_END = _dt.datetime(2024, 1, 20)
LATE_CUT = "2024-01-20 00:00:00"
FRESHNESS_AS_OF = _dt.datetime(1999, 1, 1, 0, 30)


def _records(spark, sf_dir):
    return fixtures.order_topic(spark, sf_dir)


@register("decode_orders")
def q_decode_orders(spark, sf_dir):
    return decode_orders(_records(spark, sf_dir))


@register("validate_orders")
def q_validate_orders(spark, sf_dir):
    return validate_orders(decode_orders(_records(spark, sf_dir)))


@register("flag_fraud")
def q_flag_fraud(spark, sf_dir):
    return order_flow.flagged_orders(_records(spark, sf_dir), F1_RULE)


@register("fraud_orders")
def q_fraud_orders(spark, sf_dir):
    return rules.fraud_orders(order_flow.flagged_orders(_records(spark, sf_dir), F1_RULE))


@register("valid_orders")
def q_valid_orders(spark, sf_dir):
    return rules.valid_orders(order_flow.flagged_orders(_records(spark, sf_dir), F1_RULE))


@register("fraud_alert_json")
def q_fraud_alert_json(spark, sf_dir):
    """Alert payloads, re-parsed: JSON text is compared through its fields."""
    fraud = order_flow.alert_rows(_records(spark, sf_dir), F1_RULE)
    payload = writers.alert_payload(fraud)
    return payload.select(F.from_json("value", fraud.schema).alias("a")).select("a.*")


@register("keyed_order_json")
def q_keyed_order_json(spark, sf_dir):
    """Keyed publish payloads (key = customer_id), value re-parsed."""
    keyed = writers.keyed_payload(fixtures.order_events(spark, sf_dir))
    return keyed.select("key", F.from_json("value", ORDER_EVENT).alias("v")).select("key", "v.*")


@register("window_revenue")
def q_window_revenue(spark, sf_dir):
    return window_revenue(order_flow.clean_orders(_records(spark, sf_dir)))


@register("conform_columns")
def q_conform_columns(spark, sf_dir):
    """Flagged stream orders (fraud and valid) in the 16 load columns of raw.orders."""
    return conform.to_warehouse(order_flow.flagged_orders(_records(spark, sf_dir), F1_RULE))


# --- warehouse load (F2) --------------------------------------------------------

@register("constraint_gate")
def q_constraint_gate(spark, sf_dir):
    return load.constraint_gate(fixtures.raw_orders(spark, sf_dir))


@register("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    """Load raw orders twice into a fresh table: the second load adds nothing."""
    target = scratch_path(spark, "raw_orders_target")
    batch = fixtures.raw_orders(spark, sf_dir)
    load.insert_if_absent(spark, batch, target)
    load.insert_if_absent(spark, batch, target)
    return spark.read.parquet(target)


def _lake(spark, sf_dir):
    """Valid F1 orders written as a year/month/day Parquet lake, then scanned."""
    path = scratch_path(spark, "lake_valid")
    writers.write_partitioned(order_flow.lake_rows(_records(spark, sf_dir), F1_RULE), path,
                              cluster_by="event_time")
    return scan_valid(spark, path)


@register("scan_parquet_valid")
def q_scan_parquet_valid(spark, sf_dir):
    return _lake(spark, sf_dir)


@register("partition_counts")
def q_partition_counts(spark, sf_dir):
    return _lake(spark, sf_dir).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("order_count"))


@register("partition_pruned_scan")
def q_partition_pruned_scan(spark, sf_dir):
    return scan_range(_lake(spark, sf_dir), RANGE_START, RANGE_END)


# --- quality and profiles ---------------------------------------------------------

def _raw(spark, sf_dir):
    return fixtures.raw_orders(spark, sf_dir)


@register("check_row_counts")
def q_check_row_counts(spark, sf_dir):
    return quality.check_row_counts(_raw(spark, sf_dir))


@register("check_nulls")
def q_check_nulls(spark, sf_dir):
    return quality.check_nulls(_raw(spark, sf_dir))


@register("check_duplicates")
def q_check_duplicates(spark, sf_dir):
    return quality.check_duplicates(_raw(spark, sf_dir))


@register("check_ranges")
def q_check_ranges(spark, sf_dir):
    return quality.check_ranges(_raw(spark, sf_dir))


@register("check_fraud_logic")
def q_check_fraud_logic(spark, sf_dir):
    return quality.check_fraud_logic(_raw(spark, sf_dir), F2_RULE)


@register("check_partitions")
def q_check_partitions(spark, sf_dir):
    return quality.check_partitions(_raw(spark, sf_dir))


@register("test_unique")
def q_test_unique(spark, sf_dir):
    return quality.test_unique(_stg(spark, sf_dir), "order_id")


@register("test_not_null")
def q_test_not_null(spark, sf_dir):
    return quality.test_not_null(_raw(spark, sf_dir), ["order_id", "customer_id", "amount", "order_timestamp"])


@register("test_accepted_range")
def q_test_accepted_range(spark, sf_dir):
    return quality.test_accepted_range(_stg(spark, sf_dir), "total_amount", 0, 10000)


@register("check_volume")
def q_check_volume(spark, sf_dir):
    return quality.check_volume(_stg(spark, sf_dir), 100)


@register("test_fraud_accuracy")
def q_test_fraud_accuracy(spark, sf_dir):
    return quality.test_fraud_accuracy(_stg(spark, sf_dir), F2_RULE)


@register("test_freshness")
def q_test_freshness(spark, sf_dir):
    return quality.test_freshness(staging.stg_orders(fixtures.mixed_raw_orders(spark, sf_dir)), FRESHNESS_AS_OF)


@register("test_accepted_values")
def q_test_accepted_values(spark, sf_dir):
    return quality.test_accepted_values(fixtures.order_events(spark, sf_dir), "product_category")


@register("test_category_range")
def q_test_category_range(spark, sf_dir):
    return quality.test_category_range(fixtures.order_events(spark, sf_dir))


def warehouse_checks(spark, sf_dir) -> dict:
    """The verification suite over raw.orders and the staging models."""
    raw = _raw(spark, sf_dir)
    stg = _stg(spark, sf_dir)
    return {
        "check_row_counts": lambda: quality.check_row_counts(raw),
        "check_nulls": lambda: quality.check_nulls(raw),
        "check_duplicates": lambda: quality.check_duplicates(raw),
        "check_ranges": lambda: quality.check_ranges(raw),
        "check_fraud_logic": lambda: quality.check_fraud_logic(raw, F2_RULE),
        "check_partitions": lambda: quality.check_partitions(raw),
        "test_unique_order_id": lambda: quality.test_unique(stg, "order_id"),
        "test_not_null_order_id": lambda: quality.test_not_null(stg, ["order_id", "total_amount", "order_date"]),
        "test_accepted_range_total_amount": lambda: quality.test_accepted_range(stg, "total_amount", 0, 10000),
        "test_fraud_accuracy": lambda: quality.test_fraud_accuracy(stg, F2_RULE),
        "check_volume": lambda: quality.check_volume(stg, 100),
    }


@register("quality_summary")
def q_quality_summary(spark, sf_dir):
    """The verification suite's verdicts (fused: raw read once, two keyed aggregations)."""
    return quality.warehouse_summary(_raw(spark, sf_dir), F2_RULE)


@register("order_totals")
def q_order_totals(spark, sf_dir):
    return profile.order_totals(_raw(spark, sf_dir))


@register("category_counts")
def q_category_counts(spark, sf_dir):
    return profile.category_counts(_raw(spark, sf_dir))


@register("latest_orders")
def q_latest_orders(spark, sf_dir):
    return profile.latest_orders(_raw(spark, sf_dir))


# --- streaming (a topic of files with offsets, run to the end of the input) ----------

# Fixed values of the registered queries: micro-batches of a run over the whole
# topic, the documented cap of offsets per micro-batch, messages that are looked at.
MICRO_BATCHES = 4
OFFSETS_PER_TRIGGER = 1000
PEEKED = 1000


def _topic(spark, sf_dir, checkpoint):
    """F1 topic records, appended in time order, as a stream of MICRO_BATCHES micro-batches."""
    path = append_topic(_records(spark, sf_dir), scratch_path(spark, "orders_topic"))
    return topic_stream(spark, path, checkpoint, "earliest", max_offsets=-(-size(path) // MICRO_BATCHES))


@register("stream_valid_parquet")
def q_stream_valid_parquet(spark, sf_dir):
    """K1: the streaming lake sink, read back after the stream has drained."""
    checkpoint = scratch_path(spark, "ckpt_valid")
    return pipeline.run_valid_lake(spark, _topic(spark, sf_dir, checkpoint), scratch_path(spark, "stream_lake"), checkpoint, F1_RULE)


@register("stream_window_revenue")
def q_stream_window_revenue(spark, sf_dir):
    """A1 on the stream (update mode, several micro-batches); final state equals the batch twin."""
    checkpoint = scratch_path(spark, "ckpt_windows")
    return pipeline.run_window_revenue(spark, _topic(spark, sf_dir, checkpoint), scratch_path(spark, "window_log"), checkpoint)


@register("stream_restart")
def q_stream_restart(spark, sf_dir):
    """A stopped window query goes on from its checkpoint, state included, when more has arrived."""
    path, log, checkpoint = (scratch_path(spark, x) for x in ("restart_topic", "restart_log", "ckpt_restart"))
    records = _records(spark, sf_dir)
    early = F.col("timestamp") < F.to_timestamp(F.lit(LATE_CUT))
    for part in (early, ~early):
        append_topic(records.filter(part), path)
        windows = pipeline.run_window_revenue(spark, topic_stream(spark, path, checkpoint, "earliest", max_appends=1), log, checkpoint)
    return windows


def _late_topic(spark, sf_dir, checkpoint):
    """Three appends, each a micro-batch: events before LATE_CUT, those after it, and last every tenth event.

    A micro-batch drops what lies behind the watermark that its predecessor
    began with, so the events before LATE_CUT set the one that counts here.
    """
    path = scratch_path(spark, "late_topic")
    records = _records(spark, sf_dir)
    early = F.col("timestamp") < F.to_timestamp(F.lit(LATE_CUT))
    for part in (early & F.expr("offset % 10 <> 0"), ~early & F.expr("offset % 10 <> 0"), F.expr("offset % 10 = 0")):
        append_topic(records.filter(part), path)
    return topic_stream(spark, path, checkpoint, "earliest", max_appends=1)


@register("stream_late_data")
def q_stream_late_data(spark, sf_dir):
    """Every tenth event arrives after all others; those behind the watermark are dropped."""
    checkpoint = scratch_path(spark, "ckpt_late")
    return pipeline.run_window_revenue(spark, _late_topic(spark, sf_dir, checkpoint), scratch_path(spark, "late_log"), checkpoint)


@register("stream_open_windows")
def q_stream_open_windows(spark, sf_dir):
    """The windows left in the state store (RocksDB, changelog checkpoints) when late data has passed."""
    checkpoint = scratch_path(spark, "ckpt_state")
    with large_state(spark):
        pipeline.run_window_revenue(spark, _late_topic(spark, sf_dir, checkpoint), scratch_path(spark, "state_log"), checkpoint)
    return open_windows(spark, checkpoint)


@register("stream_fanout")
def q_stream_fanout(spark, sf_dir):
    """Lake, alerts and windows from one read of a topic with late data; the rows of all three, and the late ones counted."""
    paths = fanout.FanoutPaths.below(scratch_path(spark, "fanout"))
    records = _late_topic(spark, sf_dir, paths.checkpoint)
    drain(fanout.start_fanout(records, paths, F1_RULE, pipeline.no_pause(), merge_every=3))
    lake = fanout.lake_orders(spark, paths)
    alerts = fanout.alerts(spark, paths).select(F.from_json("value", lake.drop(*writers.PARTITION_COLUMNS, "batch_id").schema).alias("a")).select("a.*")
    order = ("order_id AS key", "event_time AS at", "amount", "1L AS orders")
    return (lake.selectExpr("'lake' AS output", *order)
            .unionByName(alerts.selectExpr("'alert' AS output", *order))
            .unionByName(fanout.window_totals(spark, paths).selectExpr(
                "'window' AS output", "product_category AS key", "window_start AS at", "total_revenue AS amount", "order_count AS orders"))
            .unionByName(fanout.marks(spark, paths).groupBy().agg(F.sum("late_rows").alias("orders")).selectExpr(
                "'late' AS output", "CAST(NULL AS STRING) AS key", "CAST(NULL AS TIMESTAMP) AS at", "CAST(NULL AS DOUBLE) AS amount", "orders")))


def _by_user(spark, sf_dir):
    """F1 topic records in four topic partitions by the customer's number."""
    customer = F.substring(F.col("key").cast("string"), 6, 20).cast("long")
    return _records(spark, sf_dir).withColumn("partition", (customer % 4).cast("int"))


@register("topic_peek")
def q_topic_peek(spark, sf_dir):
    """The first messages in (partition, offset) order by a bounded read that plans no others."""
    path = append_topic(_by_user(spark, sf_dir), scratch_path(spark, "peek_topic"))
    seen = peek_messages(topic_records(spark, path, max_messages=PEEKED), PEEKED)
    return seen.select("key", "partition", "offset", "value.order_id", "value.amount")


def _run_from_latest(spark, sf_dir):
    """(batch, order_id, partition, offset) of a capped stream that starts at the latest offsets.

    Even events are in the topic before the start, odd ones arrive after it.
    """
    path, checkpoint, out = (scratch_path(spark, x) for x in ("latest_topic", "ckpt_latest", "latest_rows"))
    records = _by_user(spark, sf_dir)
    append_topic(records.filter("offset % 2 = 0"), path)

    kept = (F.from_json(F.col("value").cast("string"), ORDER_EVENT)["order_id"].alias("order_id"), F.col("partition"), F.col("offset"))

    def keep(batch, batch_id):
        batch.select(*kept).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{out}/batch={batch_id}")

    stream = topic_stream(spark, path, checkpoint, max_offsets=OFFSETS_PER_TRIGGER, small=True)
    with quick_checkpoints(spark, checkpoint):
        query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    append_topic(records.filter("offset % 2 = 1"), path)
    drain(query)
    return spark.read.parquet(out).withColumn("batch", F.col("batch").cast("long"))


@register("topic_from_latest")
def q_topic_from_latest(spark, sf_dir):
    """What arrives after the start, at the topic's own offsets."""
    return _run_from_latest(spark, sf_dir).drop("batch")


@register("topic_batch_sizes")
def q_topic_batch_sizes(spark, sf_dir):
    """Offsets per micro-batch under the cap, full ones and the last."""
    return _run_from_latest(spark, sf_dir).groupBy("batch").agg(F.count(F.lit(1)).alias("offsets")).groupBy("offsets").agg(
        F.count(F.lit(1)).alias("batches"))


@register("load_batch_and_stream")
def q_load_batch_and_stream(spark, sf_dir):
    """K5: even events by batch from a lake, odd ones by stream, both delivered twice, into one day-partitioned table."""
    root = scratch_path(spark, "load_both")
    records = _records(spark, sf_dir)
    writers.write_partitioned(order_flow.lake_rows(records.filter("offset % 2 = 0"), F1_RULE), f"{root}/lake")
    stage_topic(records.filter("offset % 2 = 1"), f"{root}/topic")
    for n in (1, 2):
        load_lake(spark, f"{root}/lake", f"{root}/raw")
        pipeline.start_warehouse_load(file_topic_stream(spark, f"{root}/topic"), f"{root}/raw", f"{root}/checkpoint-{n}",
                                      F1_RULE, rejects=f"{root}/rejects", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/raw").drop("loaded_at", "source_file")


def _damaged(spark, lake):
    """A file of the lake that is no Parquet file."""
    put_text(spark, f"{lake}/year=2024/month=1/day=1/part-damaged.parquet", "not a Parquet file")


@register("load_files")
def q_load_files(spark, sf_dir):
    """Rows of the files that loaded whole, and how many files failed (one here)."""
    root = scratch_path(spark, "load_files")
    writers.write_partitioned(order_flow.lake_rows(_records(spark, sf_dir), F1_RULE), f"{root}/lake")
    _damaged(spark, f"{root}/lake")
    return file_totals(load_lake(spark, f"{root}/lake", f"{root}/raw").files).select("rows", "failed_files")


@register("load_ledger")
def q_load_ledger(spark, sf_dir):
    """Three loads of one lake; each reads the files that came since the one before, the third none."""
    root = scratch_path(spark, "load_ledger")
    records = _records(spark, sf_dir)
    loads = []
    for n, share in enumerate(("offset % 3 = 0", "offset % 3 <> 0", None), 1):
        if share:
            writers.write_partitioned(order_flow.lake_rows(records.filter(share), F1_RULE), f"{root}/lake", mode="append")
        if n == 2:
            _damaged(spark, f"{root}/lake")
        load_ = load_new_files(spark, f"{root}/lake", f"{root}/ledger", f"{root}/raw")
        loads.append(file_totals(load_.files).select(
            F.lit(n).alias("load"), F.coalesce("rows", F.lit(0)).alias("rows"), "failed_files", F.lit(load_.inserted).cast("long").alias("inserted")))
    stored = spark.read.parquet(f"{root}/raw").groupBy().agg(F.count(F.lit(1)).alias("rows"))
    return loads[0].unionByName(loads[1]).unionByName(loads[2]).unionByName(stored.select(
        F.lit(0).alias("load"), "rows", F.lit(0).cast("long").alias("failed_files"), F.lit(0).cast("long").alias("inserted")))


@register("insert_if_absent_late_months")
def q_insert_if_absent_late_months(spark, sf_dir):
    """K5: a second batch of some months against a target by month; only its months and its keys are looked up."""
    target = scratch_path(spark, "raw_by_month")
    raw = fixtures.raw_orders(spark, sf_dir)
    load.insert_if_absent(spark, raw.filter("month <= 8"), target, partition_by=("year", "month"))
    load.insert_if_absent(spark, raw.filter("month >= 7"), target, key_in_one_partition=True)
    return spark.read.parquet(target)


# --- model-level data tests (declared on the staging models) ---------------------

@register("test_unique_customers")
def q_test_unique_customers(spark, sf_dir):
    return quality.test_unique(staging.stg_customers(_stg(spark, sf_dir)), "customer_id")


@register("test_not_null_models")
def q_test_not_null_models(spark, sf_dir):
    """NULLs in the declared model columns: order_id, total_amount, order_date; customer_id, lifetime_value."""
    return _not_null_models(spark, _stg(spark, sf_dir))


def _not_null_models(spark, stg):
    stg = reread(stg, "stg_orders")  # one staging pass for both models
    orders = quality.test_not_null(stg, ["order_id", "total_amount", "order_date"]).select(
        F.lit("stg_orders").alias("model"), "column_name", F.col("order_id").alias("key"))
    customers = quality.test_not_null(staging.stg_customers(stg), ["customer_id", "lifetime_value"]).select(
        F.lit("stg_customers").alias("model"), "column_name", F.col("customer_id").alias("key"))
    return orders.unionByName(customers)


def reread(df, name):
    """The frame written to the work folder and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("test_accepted_range_lifetime_value")
def q_test_accepted_range_lifetime_value(spark, sf_dir):
    return quality.test_accepted_range(staging.stg_customers(_stg(spark, sf_dir)), "lifetime_value", 0, None)


# --- inputs with bad rows: every check has rows that pass and rows that fail -------

def _mixed(spark, sf_dir):
    return fixtures.mixed_topic(spark, sf_dir)


def _mixed_raw(spark, sf_dir):
    return fixtures.mixed_raw_orders(spark, sf_dir)


def _mixed_stg(spark, sf_dir):
    return staging.stg_orders(_mixed_raw(spark, sf_dir))


@register("decode_mixed")
def q_decode_mixed(spark, sf_dir):
    """Broken payloads give NULLs; NaN amounts are shown as NULL."""
    return decode_orders(_mixed(spark, sf_dir)).withColumn("amount", F.when(~F.isnan("amount"), F.col("amount")))


@register("validate_mixed")
def q_validate_mixed(spark, sf_dir):
    return validate_orders(decode_orders(_mixed(spark, sf_dir)))


@register("rejected_orders")
def q_rejected_orders(spark, sf_dir):
    return rejected_orders(decode_orders(_mixed(spark, sf_dir))).select(
        "order_id", "customer_id", "event_time", "kafka_timestamp", "reject_reason")


@register("window_revenue_mixed")
def q_window_revenue_mixed(spark, sf_dir):
    """A1 over all decoded orders with an event time: what is not finite counts as an order and not in sum and mean."""
    return window_revenue(decode_orders(_mixed(spark, sf_dir)).filter("event_time IS NOT NULL"))


@register("warehouse_gate_mixed")
def q_warehouse_gate_mixed(spark, sf_dir):
    """An amount that does not fit is rejected with a reason, never stored as NULL."""
    rows = conform.to_warehouse(order_flow.flagged_orders(_mixed(spark, sf_dir), F1_RULE), unfit=True)
    return load.constraint_gate(rows, not_null=load.RAW_NOT_NULL).select(
        "order_id", "category", "amount", "order_timestamp", "violations", "passed")


@register("accepted_values_mixed")
def q_accepted_values_mixed(spark, sf_dir):
    return quality.test_accepted_values(validate_orders(decode_orders(_mixed(spark, sf_dir))), "product_category")


@register("category_range_mixed")
def q_category_range_mixed(spark, sf_dir):
    return quality.test_category_range(validate_orders(decode_orders(_mixed(spark, sf_dir))))


@register("event_structure_mixed")
def q_event_structure_mixed(spark, sf_dir):
    """Q16 over the decoded events; NaN amounts are not positive to it by rule, so they are left out."""
    events = decode_orders(_mixed(spark, sf_dir)).filter("NOT coalesce(isnan(amount), false)")
    return quality.check_event_structure(events).select("order_id", "customer_id", "amount", "customer_tenure_days", "violation")


@register("stg_orders_mixed")
def q_stg_orders_mixed(spark, sf_dir):
    return _mixed_stg(spark, sf_dir)


@register("staging_rejects")
def q_staging_rejects(spark, sf_dir):
    return staging.staging_rejects(_mixed_raw(spark, sf_dir)).select("order_id", "total_amount", "violations")


@register("constraint_gate_mixed")
def q_constraint_gate_mixed(spark, sf_dir):
    gated = load.constraint_gate(_mixed_raw(spark, sf_dir), checks=load.CHECKS + load.WIDTHS)
    return gated.select("order_id", "customer_id", "product_id", "order_timestamp", "violations", "passed")


@register("insert_if_absent_mixed")
def q_insert_if_absent_mixed(spark, sf_dir):
    """K5 over the accepted rows, delivered twice; repeated rows are stored once."""
    accepted, _ = load.split_gate(_mixed_raw(spark, sf_dir))
    target = scratch_path(spark, "raw_mixed_target")
    for _ in range(2):
        load.insert_if_absent(spark, accepted, target, partition_by=None)
    return spark.read.parquet(target).select("order_id")


for _name, _check in {
    "check_nulls_mixed": quality.check_nulls,
    "check_ranges_mixed": quality.check_ranges,
    "check_duplicates_mixed": quality.check_duplicates,
    "check_fraud_logic_mixed": lambda raw: quality.check_fraud_logic(raw, F2_RULE),
    "test_not_null_mixed": lambda raw: quality.test_not_null(raw, ["order_id", "customer_id", "amount", "order_timestamp"]).select(
        "column_name", "product_id", "category", "year"),
}.items():
    register(_name)(lambda spark, sf_dir, check=_check: check(_mixed_raw(spark, sf_dir)))

for _name, _check in {
    "test_fraud_accuracy_mixed": lambda stg: quality.test_fraud_accuracy(stg, F2_RULE),
    "check_volume_short": lambda stg: quality.check_volume(stg, 1_000_000_000),
    "test_accepted_range_lifetime_value_mixed": lambda stg: quality.test_accepted_range(
        staging.stg_customers(stg), "lifetime_value", 500_000, None),
}.items():
    register(_name)(lambda spark, sf_dir, check=_check: check(_mixed_stg(spark, sf_dir)))


@register("check_row_counts_rejects")
def q_check_row_counts_rejects(spark, sf_dir):
    """Q1 failing: the table of rows that the gate rejects is empty for clean input."""
    _, rejected = load.split_gate(_raw(spark, sf_dir))
    return quality.check_row_counts(rejected)


@register("check_partitions_unfilled")
def q_check_partitions_unfilled(spark, sf_dir):
    """Q6 failing: files read one by one lose their folder's day, as a loader that opens single objects does."""
    return quality.check_partitions(_mixed_raw(spark, sf_dir).withColumn("day", F.lit(None).cast("int")))


@register("not_null_models_mixed")
def q_not_null_models_mixed(spark, sf_dir):
    return _not_null_models(spark, _mixed_stg(spark, sf_dir))


@register("quality_summary_mixed")
def q_quality_summary_mixed(spark, sf_dir):
    return quality.warehouse_summary(_mixed_raw(spark, sf_dir), F2_RULE)


@register("quality_summary_missing_column")
def q_quality_summary_missing_column(spark, sf_dir):
    """Q17 with a column missing: its check fails with the error, the others go on."""
    return quality.warehouse_summary(_raw(spark, sf_dir).drop("year"), F2_RULE)


@register("hourly_rollup")
def q_hourly_rollup(spark, sf_dir):
    """K9: the rollup table, filled from the mixed rows and refreshed in place from the clean ones."""
    name = f"hourly_rollup_{uuid.uuid4().hex[:12]}"
    writers.refresh_rollup(spark, marts.hourly_metrics(_mixed_raw(spark, sf_dir)), name)
    return spark.table(writers.refresh_rollup(spark, marts.hourly_metrics(_raw(spark, sf_dir)), name))


@register("hourly_rollup_new_rows")
def q_hourly_rollup_new_rows(spark, sf_dir):
    """K9: the rollup of most rows, then refreshed for the months of rows that came later (some of March and June)."""
    root, parts = scratch_path(spark, "rollup_parts"), ("year", "month")
    raw, later = _raw(spark, sf_dir), "month IN (3, 6) AND order_id LIKE '%2'"

    def store(rows):
        rows.repartitionByRange("order_timestamp").write.mode("append").partitionBy(*parts).parquet(f"{root}/raw")
        return spark.read.parquet(f"{root}/raw")

    first = store(raw.filter(f"NOT ({later})"))
    writers.refresh_rollup_parts(first, first, marts.hourly_metrics, f"{root}/rollup", parts=parts)
    return writers.refresh_rollup_parts(store(raw.filter(later)), raw.filter(later), marts.hourly_metrics, f"{root}/rollup", parts=parts)


@register("model_views")
def q_model_views(spark, sf_dir):
    """K8: customer 360 through views stored as SQL text, read by another session."""
    mark = uuid.uuid4().hex[:12]
    _mixed_raw(spark, sf_dir).write.format("parquet").saveAsTable(f"raw_orders_{mark}")
    database = spark.catalog.currentDatabase()
    views = sql_models.create_views(spark, f"{database}.raw_orders_{mark}", f"staging_{mark}", f"intermediate_{mark}")
    return spark.newSession().table(views["int_customer_360"])


@register("stored_failures")
def q_stored_failures(spark, sf_dir):
    """Failing rows of a check kept in a table of the results schema, one run after the other."""
    stg = _mixed_stg(spark, sf_dir)
    name = f"accepted_range_{uuid.uuid4().hex[:12]}"
    for _ in range(2):
        table = writers.store_failures(quality.test_accepted_range(stg, "total_amount", 0, 10000), name)
    return spark.table(table).select("order_id", "total_amount")
