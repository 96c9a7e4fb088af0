"""The streaming order job: one clean stream fanned out to three queries.

records -> decode -> validate -> flag, then
  valid orders -> partitioned Parquet lake      (K1, append)
  fraud orders -> alert topic / JSON lines      (K2, append)
  all clean    -> 5-minute revenue per category (A1, update, watermark)
Each query has its own checkpoint, so each resumes where it stopped (W6);
triggers are processing-time (W5) or availableNow, and the file stand-in
of the topic is rate-limited by maxFilesPerTrigger (W7).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import DEFAULT_RULE, DEFAULT_TOPICS, DEFAULT_WINDOW, FraudRule, TopicSpec, WindowSpec
from orderlens.operators import conform, load
from orderlens.plans.order_flow import alert_rows, clean_orders, flagged_orders, lake_rows
from orderlens.schemas import RAW_ORDERS
from orderlens.sinks import writers
from orderlens.sources.topic import file_topic_stream
from orderlens.sources.topic_log import drain
from orderlens.streaming.windows import latest_per_window, window_revenue


@dataclass(frozen=True)
class PipelinePaths:
    lake: str
    alerts: str
    window_log: str
    checkpoints: str


def start_pipeline(records: DataFrame, paths: PipelinePaths, rule: FraudRule = DEFAULT_RULE,
                   spec: WindowSpec = DEFAULT_WINDOW, available_now: bool = False,
                   bootstrap_servers: str | None = None, window_to_console: bool = False,
                   topics: TopicSpec = DEFAULT_TOPICS) -> dict:
    """Start the three queries over one streaming lineage; returns them by name.

    The window query writes its update log with foreachBatch unless
    `window_to_console`; its final state is `latest_per_window` of the log.
    """
    lake = writers.valid_parquet_sink(lake_rows(records, rule), paths.lake, f"{paths.checkpoints}/valid_orders",
                                      spec, available_now)
    alerts = writers.alert_sink(alert_rows(records, rule), f"{paths.checkpoints}/fraud_alerts",
                                bootstrap_servers=bootstrap_servers, path=paths.alerts, spec=topics, window=spec,
                                available_now=available_now)
    windowed = window_revenue(clean_orders(records), spec)
    if window_to_console:
        agg = writers.window_sink(windowed, f"{paths.checkpoints}/aggregations", spec, sink="console",
                                  available_now=available_now)
    else:
        agg = writers.window_sink(windowed, f"{paths.checkpoints}/aggregations", spec,
                                  foreach_batch=writers.update_log_writer(paths.window_log),
                                  available_now=available_now)
    return {"valid_orders": lake, "fraud_alerts": alerts, "aggregations": agg}


#: Triggers without a pause, for runs to the end of what a source holds.
AT_ONCE = {"trigger": "0 seconds", "aggregate_trigger": "0 seconds"}


def no_pause(spec: WindowSpec = DEFAULT_WINDOW) -> WindowSpec:
    return replace(spec, **AT_ONCE)


def _drained(q, available_now: bool, progress: list | None) -> None:
    """Wait for the end of the input; a source with its own admission is drained and stopped."""
    if available_now:
        q.awaitTermination()
        reports = q.recentProgress
    else:
        reports = drain(q)
    if progress is not None:
        progress += reports


def run_valid_lake(spark: SparkSession, source: str | DataFrame, lake: str, checkpoint: str,
                   rule: FraudRule = DEFAULT_RULE, max_files_per_trigger: int | None = None,
                   progress: list | None = None) -> DataFrame:
    """K1 alone, run to the end of the staged input (a folder of files, or a stream of records that
    admits by itself); returns the lake as written.

    `progress` receives the progress reports of the micro-batches.
    """
    files = isinstance(source, str)
    stream = file_topic_stream(spark, source, max_files_per_trigger) if files else source
    q = writers.valid_parquet_sink(lake_rows(stream, rule), lake, checkpoint, no_pause(), available_now=files)
    _drained(q, files, progress)
    return spark.read.parquet(lake)


def run_window_revenue(spark: SparkSession, source: str | DataFrame, log: str, checkpoint: str,
                       spec: WindowSpec = DEFAULT_WINDOW, max_files_per_trigger: int | None = None,
                       progress: list | None = None) -> DataFrame:
    """A1 on a stream, run to the end of the staged input (as in `run_valid_lake`); returns the final window state.

    `progress` receives the progress reports of the micro-batches.
    """
    files = isinstance(source, str)
    stream = file_topic_stream(spark, source, max_files_per_trigger) if files else source
    spec = no_pause(spec)
    q = writers.window_sink(window_revenue(clean_orders(stream), spec), checkpoint, spec,
                            foreach_batch=writers.update_log_writer(log), available_now=files)
    _drained(q, files, progress)
    return latest_per_window(spark.read.parquet(log))


def start_warehouse_load(records: DataFrame, target: str | None, checkpoint: str, rule: FraudRule = DEFAULT_RULE,
                         rejects: str | None = None, available_now: bool = False,
                         spec: WindowSpec = DEFAULT_WINDOW, table: str | None = None, buckets: int | None = None):
    """K5 on a stream: flagged orders -> raw.orders columns -> gate -> insert-if-absent.

    Each micro-batch is loaded with the anti join against the target, so a
    batch delivered twice (a restart after a failure before the checkpoint
    commit) inserts nothing the second time. A Parquet `target` keeps its
    layout (a new one gets the one of the batch load); with `table`, a
    catalog table bucketed by order_id, a micro-batch never shuffles the
    key history: the form for a large target. Rejected rows are written
    below `rejects` under their batch id, overwriting what an earlier
    delivery of the batch left there.
    """
    rows = conform.to_warehouse(flagged_orders(records, rule), columns=RAW_ORDERS.fieldNames(), unfit=True).withColumn(
        "loaded_at", F.current_timestamp())

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # parsed once for both writes
        try:
            accepted, rejected = load.split_gate(batch, not_null=load.RAW_NOT_NULL, checks=load.CHECKS + load.WIDTHS)
            if table:
                load.insert_if_absent_table(spark, accepted, table, buckets=buckets)
            else:
                new = load.target_layout(spark, target) is None
                load.insert_if_absent(spark, accepted, target, partition_by=load.RAW_LAYOUT if new else None)
            if rejects:
                rejected.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=spec.trigger)
    return writer.start()
