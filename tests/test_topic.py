"""Topic readers and keyed payloads (connector builders are configured, not run)."""

from pyspark.sql import functions as F

from orderlens.config import TopicSpec
from orderlens.sinks import writers
from orderlens.sources import fixtures
from orderlens.sources.topic import peek_messages, topic_batch_reader, topic_stream_reader
from tests.conftest import SF_SMALL


def test_builders_configure_without_connecting(spark):
    assert topic_stream_reader(spark, "broker:9092", TopicSpec()) is not None
    assert topic_batch_reader(spark, "broker:9092", "orders.raw") is not None
    opts = writers.topic_writer_options("broker:9092", "fraud.alerts")
    assert opts["kafka.acks"] == "all" and opts["kafka.compression.type"] == "gzip"


def test_keyed_payload_keeps_customer_in_key(spark):
    events = fixtures.order_events(spark, SF_SMALL)
    keyed = writers.keyed_payload(events)
    row = keyed.first()
    assert row.key.startswith("cust-") and '"order_id"' in row.value


def test_peek_first_messages_with_offsets(spark):
    records = fixtures.order_topic(spark, SF_SMALL)
    first = peek_messages(records, 5)
    rows = first.collect()
    assert len(rows) == 5 and rows[0].value.order_id is not None
    assert [r.offset for r in rows] == sorted(r.offset for r in rows)


def test_topic_partition_follows_key(spark):
    records = fixtures.order_topic(spark, SF_SMALL)
    per_key = records.groupBy("key").agg(F.countDistinct("partition").alias("p"))
    assert per_key.filter("p > 1").count() == 0
