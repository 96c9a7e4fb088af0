"""Topic readers (S1, S2) and their file-backed stand-ins.

The topic connector is a Spark package the caller adds to the session
(`spark.jars.packages`); the builders only configure readers. Offline, the
same record shape is staged as Parquet files and read with the file source,
whose `maxFilesPerTrigger` plays the part of `maxOffsetsPerTrigger`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import DEFAULT_TOPICS, TopicSpec
from orderlens.schemas import ORDER_EVENT, TOPIC_RECORD
from orderlens.sources.store import date_in_order, names


def topic_stream_reader(spark: SparkSession, bootstrap_servers: str, spec: TopicSpec = DEFAULT_TOPICS,
                        options: dict | None = None):
    """Streaming reader of the input topic (latest offsets, rate-limited)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", spec.input_topic)
        .option("startingOffsets", spec.starting_offsets)
    )
    if spec.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(spec.max_offsets_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader


def topic_batch_reader(spark: SparkSession, bootstrap_servers: str, topic: str, options: dict | None = None):
    """Bounded read of a topic from the earliest to the latest offsets."""
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader


def stage_topic(records: DataFrame, path: str, files: int | None = None) -> str:
    """Write topic records as Parquet files (the offline stand-in of a topic)."""
    out = records.repartition(files) if files else records
    out.write.mode("errorifexists").parquet(path)
    return path


def stage_topic_in_order(records: DataFrame, path: str, slices: int = 6) -> str:
    """Stage topic records in event-time order, one file per time slice, written side by side by one range sort.

    The file source takes files by their time, so the files are dated in the
    order of their slices: with `maxFilesPerTrigger=1` each slice is a
    micro-batch and rows arrive as a topic would deliver them. For input of any
    size use `topic_log`, which cuts micro-batches by offsets.
    """
    spark = records.sparkSession
    records.repartitionByRange(slices, "timestamp").write.mode("append").parquet(path)
    date_in_order(spark, path, [n for n in names(spark, path) if n.endswith(".parquet")])
    return path


def file_topic_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream topic records from staged files (schema declared, never inferred)."""
    reader = spark.readStream.schema(TOPIC_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def peek_messages(records: DataFrame, max_messages: int, schema=ORDER_EVENT) -> DataFrame:
    """The first N messages of a bounded read, decoded, with partition and offset."""
    decoded = records.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), schema).alias("value"),
        "partition", "offset",
    )
    return decoded.orderBy("partition", "offset").limit(max_messages)
