"""Writers for the pipeline outputs.

Streams: the valid-order lake (K1), the alert topic (K2), the windowed
revenue (K3), keyed publishing (K4). Batch: model materialization (K7-K9),
failure store (K10), layer / table DDL (K12, K13), statistics (K17) and a
JDBC writer (K18). Topic and JDBC connectors are packages the caller adds
to the session; the builders only configure them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import DEFAULT_TOPICS, DEFAULT_WINDOW, TopicSpec, WindowSpec
from orderlens.functions import date_parts
from orderlens.operators.load import batch_partitions
from orderlens.schemas import (
    CUSTOMER_METRICS_TABLE,
    DAILY_REVENUE_TABLE,
    RAW_ORDERS,
    STAGING_ORDERS_TABLE,
    ddl,
)
from orderlens.sources.store import delete, names

PARTITION_COLUMNS = ("year", "month", "day")


# --- stream sinks -------------------------------------------------------------

def valid_parquet_sink(valid: DataFrame, path: str, checkpoint: str,
                       spec: WindowSpec = DEFAULT_WINDOW, available_now: bool = False):
    """K1: append valid orders to Parquet, partitioned by event year/month/day."""
    writer = (
        valid.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*PARTITION_COLUMNS)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=spec.trigger)
    return writer.start()


def alert_payload(fraud: DataFrame) -> DataFrame:
    """The whole row as one JSON `value` (NULL fields are omitted)."""
    return fraud.select(F.to_json(F.struct("*")).alias("value"))


def keyed_payload(orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """K4: key = customer_id (one customer stays in one topic partition), value = JSON row."""
    return orders.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def topic_writer_options(bootstrap_servers: str, topic: str) -> dict:
    """Options of a reliable topic producer: all replicas ack, 3 retries, gzip."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.compression.type": "gzip",
    }


def publish(orders: DataFrame, topic: str, bootstrap_servers: str | None = None, path: str | None = None,
            checkpoint: str | None = None, available_now: bool = False, key: str = "customer_id"):
    """K4: publish orders keyed by customer to a topic, from a batch or a stream.

    Offline (`path` instead of servers) the same records are staged as Parquet
    files. A stream needs a checkpoint and returns its query.
    """
    payload = keyed_payload(orders, key)
    if not bootstrap_servers:
        payload = payload.withColumn("topic", F.lit(topic))
    options = topic_writer_options(bootstrap_servers, topic) if bootstrap_servers else {"path": path}
    fmt = "kafka" if bootstrap_servers else "parquet"
    if payload.isStreaming:
        writer = payload.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    payload.write.format(fmt).options(**options).mode("append").save()
    return None


def alert_sink(fraud: DataFrame, checkpoint: str, bootstrap_servers: str | None = None,
               path: str | None = None, spec: TopicSpec = DEFAULT_TOPICS,
               window: WindowSpec = DEFAULT_WINDOW, available_now: bool = False):
    """K2: stream alerts to the alert topic, or (offline) to text files of JSON lines."""
    payload = alert_payload(fraud)
    if bootstrap_servers:
        writer = payload.writeStream.format("kafka")
        for k, v in topic_writer_options(bootstrap_servers, spec.alert_topic).items():
            writer = writer.option(k, v)
    else:
        writer = payload.writeStream.format("text").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=window.trigger)
    return writer.start()


def window_sink(windowed: DataFrame, checkpoint: str, spec: WindowSpec = DEFAULT_WINDOW,
                sink: str = "console", query_name: str | None = None, foreach_batch=None,
                available_now: bool = False):
    """Update-mode output of the windowed aggregate (console, memory or foreachBatch)."""
    writer = windowed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(sink)
        if sink == "console":
            writer = writer.option("truncate", "false")
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=spec.aggregate_trigger)
    return writer.start()


def update_log_writer(path: str):
    """foreachBatch function appending each batch's updates with its batch id.

    A batch replayed after a failure appends the same rows again under the
    same id; `latest_per_window` keeps the max (batch id, values) per key,
    so replays do not change the final state.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(path)
    return write


# --- batch writers --------------------------------------------------------------

def write_partitioned(df: DataFrame, path: str, mode: str = "errorifexists",
                      cluster_by: str | None = None) -> str:
    """Batch twin of K1: Hive-style year/month/day Parquet layout.

    By default rows are written where they are (no shuffle); each task
    writes one file per day it holds. `cluster_by` (an event-time column)
    range-partitions on it first: boundaries come from a sample, so a hot
    day is split over several tasks, and each file covers a narrow time
    span (tight min/max statistics for pruning inside a day).
    """
    if cluster_by:
        df = df.repartitionByRange(F.col(cluster_by)).sortWithinPartitions(cluster_by)
    df.write.mode(mode).partitionBy(*PARTITION_COLUMNS).parquet(path)
    return path


def materialize_table(spark: SparkSession, df: DataFrame, name: str, keep: int = 2) -> str:
    """K7: full refresh of a model table without a moment in which it is missing.

    Every refresh is written to a version folder of its own beside the
    database; then one catalog change names it (`CREATE OR REPLACE VIEW` over the
    folder: sessions look a view up for every query, while the location of a
    table stays in the cache of sessions that have read it). A model may read
    the table it replaces, its columns may change, a failed run leaves the old
    version in place, and a reader that began before the change finishes on its
    version: `keep` former versions stay, older ones go.
    """
    database, _, table = name.rpartition(".")
    where = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    folder = f"{where.rstrip('/')}/{table}__versions"
    number = max((int(n) for n in names(spark, folder) if n.isdigit()), default=0) + 1
    df.write.mode("overwrite").parquet(f"{folder}/{number}")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a table of an earlier layout, once
    create_view(spark, name, f"SELECT * FROM parquet.`{folder}/{number}`")
    for n in names(spark, folder):
        if n.isdigit() and int(n) < number - keep:
            delete(spark, f"{folder}/{n}")
    return name


def materialize_view(df: DataFrame, name: str) -> str:
    """K8: a model as a (session) view: recomputed by every reader, like a SQL view."""
    df.createOrReplaceTempView(name)
    return name


def create_view(spark: SparkSession, name: str, query: str) -> str:
    """K8: a model as a lasting view of the catalog, for every session; replaced in one step."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return name


def refresh_rollup_parts(source: DataFrame, touched: DataFrame, rollup, path: str, hour: str = "hour",
                         parts=PARTITION_COLUMNS) -> DataFrame:
    """K9: refresh only what new rows change; returns the rollup as stored at `path`.

    `source` (all rows) is partitioned by `parts` (year, month, day or the
    first of them) of the rollup's time, `touched` are its new rows. Their
    parts are read again, as a predicate on the folders, rolled up, and replace
    those folders of the rollup; others are neither read nor written.
    """
    spark = source.sparkSession
    here = batch_partitions(touched, list(parts))
    rows = rollup(source if here is None else source.filter(here))
    rows = rows.select("*", *date_parts(hour)).drop(*[c for c in PARTITION_COLUMNS if c not in parts])
    rows.repartitionByRange(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    return spark.read.parquet(path).drop(*parts)


def refresh_rollup(spark: SparkSession, df: DataFrame, name: str) -> str:
    """K9: refresh a rollup table (INSERT OVERWRITE; created on first refresh)."""
    if spark.catalog.tableExists(name):
        df.write.insertInto(name, overwrite=True)
    else:
        df.write.format("parquet").saveAsTable(name)
    return name


def store_failures(violations: DataFrame, check: str, schema: str = "test_results") -> str:
    """Keep the failing rows of a check in `test_results.<check>`."""
    spark = violations.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    name = f"{schema}.{check}"
    violations.write.mode("append").format("parquet").option("mergeSchema", "true").saveAsTable(name)
    return name


def create_layers(spark: SparkSession, layers=("raw", "staging", "analytics"), replace: bool = False) -> list:
    """One database per layer; dropping old ones only when asked."""
    for layer in layers:
        if replace:
            spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    return list(layers)


def create_raw_orders_table(spark: SparkSession, name: str = "raw.orders") -> str:
    """The warehouse table with column defaults and comments.

    NOT NULL / CHECK are not enforced by Parquet tables; the constraint gate
    applies them before every write.
    """
    cols = ddl(RAW_ORDERS).replace(" NOT NULL", "")
    cols = cols.replace("`loaded_at` timestamp", "`loaded_at` timestamp DEFAULT current_timestamp()")
    cols = cols.replace("`customer_age_days` int", "`customer_age_days` int COMMENT 'Days since customer registration'")
    cols = cols.replace("`is_fraud` boolean", "`is_fraud` boolean COMMENT 'Fraud flag from the streaming job'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY (year, month, day) COMMENT 'Raw orders loaded from the Parquet lake'")
    return name


def _create(spark: SparkSession, name: str, schema, defaults: dict, comment: str, partitioned_by=None) -> str:
    cols = []
    for f in schema.fields:
        col = f"`{f.name}` {f.dataType.simpleString()}"
        if f.name in defaults:
            col += f" DEFAULT {defaults[f.name]}"
        cols.append(col)
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet{parts} COMMENT '{comment}'")
    return name


def create_warehouse_tables(spark: SparkSession) -> list:
    """K12 + K13: the layer databases and every declared table, with defaults.

    Primary keys, NOT NULL and CHECK constraints are enforced by the gate and
    by insert-if-absent, not by the (Parquet) tables.
    """
    create_layers(spark, ("raw", "staging", "analytics"))
    now = "current_timestamp()"
    return [
        create_raw_orders_table(spark, "raw.orders"),
        _create(spark, "staging.stg_orders", STAGING_ORDERS_TABLE,
                {"is_fraud": "false", "created_at": now, "updated_at": now},
                "Cleaned and deduplicated orders"),
        _create(spark, "analytics.daily_revenue", DAILY_REVENUE_TABLE, {"created_at": now},
                "Daily revenue metrics"),
        _create(spark, "analytics.customer_metrics", CUSTOMER_METRICS_TABLE,
                {"created_at": now, "updated_at": now}, "Customer lifetime value metrics"),
    ]


def load_declared(df: DataFrame, table: str, overwrite: bool = True) -> str:
    """Fill a declared table from a DataFrame with a subset of its columns.

    Columns the DataFrame lacks take the table's defaults (audit times).
    """
    spark = df.sparkSession
    view = f"_load_{uuid.uuid4().hex[:8]}"
    df.createOrReplaceTempView(view)
    cols = ", ".join(f"`{c}`" for c in df.columns)
    verb = "INSERT OVERWRITE" if overwrite else "INSERT INTO"
    spark.sql(f"{verb} {table} ({cols}) SELECT {cols} FROM {view}")
    spark.catalog.dropTempView(view)
    return table


def analyze(spark: SparkSession, name: str) -> None:
    """Refresh table and column statistics, histograms included, for the cost-based optimizer
    (`session.use_statistics`)."""
    key = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    finally:
        spark.conf.set(key, before)


def jdbc_writer(df: DataFrame, url: str, table: str, options: dict | None = None, batchsize: int = 10000):
    """Configured JDBC writer (the driver jar and credentials come from the caller)."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option(
        "batchsize", str(batchsize))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    return writer
