"""One read, three outputs (K14, P6): lake, alerts and windows from each micro-batch.

The stream is decoded once and persisted for the length of a micro-batch, whose
rows go to three places under the batch id:

* valid orders to the lake, `year=/month=/day=/batch_id=` folders;
* fraud orders to the alerts, `batch_id=` folders of JSON lines, or the alert topic;
* revenue per window, as partial sums of the batch, to an update log.

Then a mark says that the batch is complete. Each output replaces what an earlier
delivery of the batch left, and readers take marked batches only, so a restart
between two outputs loses and repeats nothing (a topic gets alerts at least
once, with the batch id as a header). Windows follow Spark's own rule for late
data: a batch drops rows of windows that ended before the watermark its
predecessor began with; the mark carries the watermark on and counts those rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.config import DEFAULT_RULE, DEFAULT_TOPICS, DEFAULT_WINDOW, FraudRule, TopicSpec, WindowSpec
from orderlens.functions import exact_money, exact_money_sum, to_double
from orderlens.operators.conform import with_partition_columns
from orderlens.operators.rules import fraud_orders, valid_orders
from orderlens.plans.order_flow import flagged_orders
from orderlens.sinks.update_log import UpdateLog
from orderlens.sinks.writers import PARTITION_COLUMNS, alert_payload, topic_writer_options
from orderlens.sources.store import exists, names

MARK = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("max_event_time", T.TimestampType()),  # of this batch and all before it
    T.StructField("late_before", T.TimestampType()),
    T.StructField("orders", T.LongType()),
    T.StructField("lake_rows", T.LongType()),
    T.StructField("alert_rows", T.LongType()),
    T.StructField("late_rows", T.LongType()),
])
PARTIAL = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("total", T.DecimalType(38, 10)),
    T.StructField("order_count", T.LongType()),
    T.StructField("amounts", T.LongType()),
])


@dataclass(frozen=True)
class FanoutPaths:
    """Folders of the three outputs, the marks and the query's checkpoint, below one root by default."""

    lake: str
    alerts: str
    windows: str
    marks: str
    checkpoint: str

    @classmethod
    def below(cls, root: str) -> FanoutPaths:
        return cls(*(f"{root.rstrip('/')}/{x}" for x in ("valid", "fraud_alerts", "windows", "marks", "checkpoint")))


def _added(parts: DataFrame) -> DataFrame:
    """Partial rows of the same window and category, added up."""
    return parts.groupBy("window_start", "window_end", "product_category").agg(
        F.sum("total").cast("decimal(38,10)").alias("total"), F.sum("order_count").alias("order_count"), F.sum("amounts").alias("amounts"))


def window_log(spark: SparkSession, paths: FanoutPaths) -> UpdateLog:
    return UpdateLog(spark, paths.windows, PARTIAL, _added)


def marks(spark: SparkSession, paths: FanoutPaths) -> DataFrame:
    """One row per complete batch."""
    if not exists(spark, paths.marks):
        return spark.createDataFrame([], MARK)
    return spark.read.schema(MARK).parquet(*[f"{paths.marks}/{n}" for n in names(spark, paths.marks) if _complete(spark, paths, n)])


def _complete(spark: SparkSession, paths: FanoutPaths, name: str) -> bool:
    return name.startswith("batch=") and exists(spark, f"{paths.marks}/{name}/_SUCCESS")


def _mark(spark: SparkSession, paths: FanoutPaths, batch_id: int):
    """The mark of one batch, None if there is none."""
    name = f"batch={batch_id}"
    if not _complete(spark, paths, name):
        return None
    return spark.read.schema(MARK).parquet(f"{paths.marks}/{name}").first()


def last_marked(spark: SparkSession, paths: FanoutPaths) -> int:
    """The last complete batch, -1 if there is none."""
    return max((int(n.split("=")[1]) for n in names(spark, paths.marks) if _complete(spark, paths, n)), default=-1)


def _delay(spec: WindowSpec) -> dt.timedelta:
    count, unit = spec.watermark.split()
    return dt.timedelta(**{unit.rstrip("s") + "s": float(count)})


def _partials(orders: DataFrame, spec: WindowSpec) -> DataFrame:
    return orders.groupBy(F.window("event_time", spec.window).alias("w"), "product_category").agg(
        exact_money_sum("amount").cast("decimal(38,10)").alias("total"), F.count(F.lit(1)).alias("order_count"),
        F.count(exact_money("amount")).alias("amounts"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "product_category", "total", "order_count", "amounts")


class Fanout:
    """Writes a micro-batch of flagged orders to the three outputs; steps run in order, the mark last."""

    def __init__(self, paths: FanoutPaths, spec: WindowSpec = DEFAULT_WINDOW, bootstrap_servers: str | None = None,
                 topics: TopicSpec = DEFAULT_TOPICS, merge_every: int = 50):
        self.paths, self.spec, self.servers, self.topics, self.merge_every = paths, spec, bootstrap_servers, topics, merge_every

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, earlier = _mark(spark, self.paths, batch_id - 1), _mark(spark, self.paths, batch_id - 2)
        late = earlier.max_event_time - _delay(self.spec) if earlier and earlier.max_event_time else None
        orders = batch.withColumn("_on_time", F.lit(True) if late is None else F.window("event_time", self.spec.window)["end"] > F.lit(late)).persist()
        try:
            self.write_lake(valid_orders(orders.drop("_on_time")), batch_id)
            self.write_alerts(fraud_orders(orders.drop("_on_time")), batch_id)
            window_log(spark, self.paths).write(_partials(orders.where("_on_time"), self.spec), batch_id)
            self.write_mark(orders, batch_id, before.max_event_time if before else None, late)
        finally:
            orders.unpersist()
        if late is not None and batch_id % self.merge_every == self.merge_every - 1:
            window_log(spark, self.paths).merge(batch_id, F.col("window_end") <= F.lit(late))

    def write_lake(self, valid: DataFrame, batch_id: int) -> None:
        rows = with_partition_columns(valid, "event_time").withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLUMNS, "batch_id").parquet(self.paths.lake)

    def write_alerts(self, fraud: DataFrame, batch_id: int) -> None:
        payload = alert_payload(fraud)
        if self.servers:
            header = F.array(F.struct(F.lit("batch_id").alias("key"), F.lit(str(batch_id)).cast("binary").alias("value")))
            payload.withColumn("headers", header).write.format("kafka").option("includeHeaders", "true").options(
                **topic_writer_options(self.servers, self.topics.alert_topic)).save()
        else:
            payload.write.mode("overwrite").text(f"{self.paths.alerts}/batch_id={batch_id}")

    def write_mark(self, orders: DataFrame, batch_id: int, before, late) -> None:
        orders.agg(
            F.lit(batch_id).cast("long").alias("batch_id"),
            F.greatest(F.max("event_time"), F.lit(before).cast("timestamp")).alias("max_event_time"),
            F.lit(late).cast("timestamp").alias("late_before"), F.count(F.lit(1)).alias("orders"),
            F.count_if(~F.col("is_fraud")).alias("lake_rows"), F.count_if("is_fraud").alias("alert_rows"),
            F.count_if(~F.col("_on_time")).alias("late_rows"),
        ).coalesce(1).write.mode("overwrite").parquet(f"{self.paths.marks}/batch={batch_id}")


def start_fanout(records: DataFrame, paths: FanoutPaths, rule: FraudRule = DEFAULT_RULE, spec: WindowSpec = DEFAULT_WINDOW,
                 available_now: bool = False, bootstrap_servers: str | None = None, topics: TopicSpec = DEFAULT_TOPICS,
                 merge_every: int = 50, sink: Fanout | None = None):
    """Start the one query over a stream of topic records."""
    sink = sink or Fanout(paths, spec, bootstrap_servers, topics, merge_every)
    writer = flagged_orders(records, rule).writeStream.foreachBatch(sink).option("checkpointLocation", paths.checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=spec.trigger)
    return writer.start()


# --- reading the outputs: complete batches only -------------------------------------

def lake_orders(spark: SparkSession, paths: FanoutPaths) -> DataFrame:
    return spark.read.parquet(paths.lake).where(F.col("batch_id") <= last_marked(spark, paths))


def alerts(spark: SparkSession, paths: FanoutPaths) -> DataFrame:
    """(batch_id, value) of the alert lines."""
    return spark.read.text(paths.alerts).where(F.col("batch_id") <= last_marked(spark, paths)).select("batch_id", "value")


def window_totals(spark: SparkSession, paths: FanoutPaths) -> DataFrame:
    """The windowed revenue so far, columns as in `window_revenue`."""
    merged = window_log(spark, paths).read(last_marked(spark, paths))
    return merged.select(
        "window_start", "window_end", "product_category", to_double("total").alias("total_revenue"), "order_count",
        (to_double("total") / F.nullif(F.col("amounts"), F.lit(0))).alias("avg_order_value"))
