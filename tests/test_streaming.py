"""Streaming: late data vs watermark, restart from checkpoint, stream = batch parity, fan-out."""

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from orderlens.config import FraudRule, WindowSpec
from orderlens.plans.order_flow import clean_orders
from orderlens.schemas import TOPIC_RECORD
from orderlens.sources import fixtures
from orderlens.sources.topic import file_topic_stream
from orderlens.streaming.pipeline import PipelinePaths, run_window_revenue, start_pipeline
from orderlens.streaming.windows import latest_per_window, window_revenue
from tests.conftest import SF_SMALL


def _record(ts: str, amount: float, oid: str, category: str = "books"):
    payload = {"order_id": oid, "customer_id": "c1", "amount": amount, "currency": "USD",
               "product_category": category, "customer_tenure_days": 50, "timestamp": ts,
               "event_type": "order_created"}
    return ("c1".encode(), json.dumps(payload).encode(), "orders.raw", 0, 0,
            dt.datetime(2024, 1, 1), 0)


def _write_batch(spark, path, rows, name):
    spark.createDataFrame(rows, TOPIC_RECORD).coalesce(1).write.parquet(f"{path}/{name}")


def _windows(spark, log):
    final = latest_per_window(spark.read.parquet(log))
    return {(r.window_start.strftime("%H:%M"), r.product_category): (r.total_revenue, r.order_count)
            for r in final.collect()}


def test_late_rows_behind_watermark_are_dropped(spark, scratch):
    src, log, ckpt = f"{scratch}/src", f"{scratch}/log", f"{scratch}/ckpt"
    os.makedirs(src)
    _write_batch(spark, src, [_record("2024-01-01T00:01:00", 10.0, "a"),
                              _record("2024-01-01T00:30:00", 5.0, "b")], "b1")
    stream = file_topic_stream(spark, f"{src}/*", max_files_per_trigger=1)
    from orderlens.sinks.writers import update_log_writer, window_sink
    q = window_sink(window_revenue(clean_orders(stream), WindowSpec()), ckpt,
                    foreach_batch=update_log_writer(log), available_now=True)
    q.awaitTermination()
    time.sleep(1.1)
    _write_batch(spark, src, [_record("2024-01-01T00:02:00", 7.0, "c"),
                              _record("2024-01-01T00:26:00", 3.0, "d")], "b2")
    # restart from the same checkpoint: only the new file is read
    stream = file_topic_stream(spark, f"{src}/*", max_files_per_trigger=1)
    q = window_sink(window_revenue(clean_orders(stream), WindowSpec()), ckpt,
                    foreach_batch=update_log_writer(log), available_now=True)
    q.awaitTermination()
    got = _windows(spark, log)
    assert got[("00:00", "books")] == (10.0, 1)      # 00:02 arrived behind the watermark (00:20)
    assert got[("00:25", "books")] == (3.0, 1)       # inside the delay: counted
    assert got[("00:30", "books")] == (5.0, 1)
    dropped = sum(p.get("stateOperators", [{}])[0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    assert dropped == 1


def test_stream_equals_batch_with_ordered_files(spark, scratch):
    """Files written one by one in event-time order, one file per trigger."""
    src = f"{scratch}/src"
    records = fixtures.order_topic(spark, SF_SMALL).orderBy("timestamp").collect()
    n = len(records)
    step = n // 4 + 1
    for i in range(4):
        chunk = records[i * step:(i + 1) * step]
        spark.createDataFrame(chunk, TOPIC_RECORD).coalesce(1).write.parquet(f"{src}/part{i}")
        time.sleep(1.1)
    streamed = run_window_revenue(spark, f"{src}/*", f"{scratch}/log", f"{scratch}/ckpt",
                                  max_files_per_trigger=1)
    batch = window_revenue(clean_orders(fixtures.order_topic(spark, SF_SMALL)))
    cols = ["window_start", "product_category", "total_revenue", "order_count"]
    assert streamed.count() == batch.count()
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_pipeline_fans_out_to_three_queries(spark, scratch):
    src = f"{scratch}/src"
    fixtures.order_topic(spark, SF_SMALL).write.parquet(src)
    paths = PipelinePaths(lake=f"{scratch}/lake", alerts=f"{scratch}/alerts", window_log=f"{scratch}/wlog",
                          checkpoints=f"{scratch}/ckpt")
    rule = FraudRule(100.0, 30)
    queries = start_pipeline(file_topic_stream(spark, src), paths, rule, available_now=True)
    for q in queries.values():
        q.awaitTermination()
    lake = spark.read.parquet(paths.lake)
    alerts = spark.read.text(paths.alerts)
    total = fixtures.order_events(spark, SF_SMALL).count()
    assert lake.count() + alerts.count() == total
    assert set(lake.columns) >= {"year", "month", "day", "event_time"}
    parsed = alerts.select(F.get_json_object("value", "$.is_fraud").alias("f")).distinct().collect()
    assert [r.f for r in parsed] == ["true"]
    assert latest_per_window(spark.read.parquet(paths.window_log)).count() > 0
    # restart: nothing new to read, nothing re-written
    queries = start_pipeline(file_topic_stream(spark, src), paths, rule, available_now=True)
    for q in queries.values():
        q.awaitTermination()
    assert spark.read.parquet(paths.lake).count() == lake.count()


def test_stream_load_is_idempotent_under_redelivery(spark, scratch):
    from orderlens.streaming.pipeline import start_warehouse_load

    src, target = f"{scratch}/src", f"{scratch}/raw"
    fixtures.order_topic(spark, SF_SMALL).write.parquet(src)
    expected = fixtures.order_events(spark, SF_SMALL).count()
    for run in range(2):  # the same input delivered twice, each time with a fresh checkpoint
        q = start_warehouse_load(file_topic_stream(spark, src), target, f"{scratch}/ckpt{run}",
                                 FraudRule(100.0, 30), rejects=f"{scratch}/rejects", available_now=True)
        q.awaitTermination()
        assert spark.read.parquet(target).count() == expected
    loaded = spark.read.parquet(target)
    assert loaded.select("order_id").distinct().count() == expected
    assert loaded.filter("is_fraud").count() > 0 and loaded.filter("loaded_at IS NULL").count() == 0


def test_console_window_sink_and_rocksdb_state(spark, scratch):
    src = f"{scratch}/src"
    fixtures.order_topic(spark, SF_SMALL).write.parquet(src)
    paths = PipelinePaths(lake=f"{scratch}/lake", alerts=f"{scratch}/alerts", window_log=f"{scratch}/wlog",
                          checkpoints=f"{scratch}/ckpt")
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        queries = start_pipeline(file_topic_stream(spark, src), paths, FraudRule(100.0, 30),
                                 available_now=True, window_to_console=True)
        for q in queries.values():
            q.awaitTermination()
        agg = queries["aggregations"]
        assert agg.lastProgress["stateOperators"][0]["numRowsTotal"] > 0
    finally:
        spark.conf.unset(key)


def test_cli_stream_once_and_models(spark, scratch, capsys):
    from orderlens.__main__ import main

    src, out = f"{scratch}/src", f"{scratch}/out"
    fixtures.order_topic(spark, SF_SMALL).write.parquet(src)
    assert main(["stream", "--source", src, "--out", out, "--once"]) == 0
    lake = spark.read.parquet(f"{out}/valid")
    assert lake.count() + spark.read.text(f"{out}/fraud_alerts").count() == fixtures.order_events(
        spark, SF_SMALL).count()
    fixtures.raw_orders(spark, SF_SMALL).write.parquet(f"{scratch}/raw")
    assert main(["models", "--raw", f"{scratch}/raw"]) == 0
    assert '"mart_daily_revenue"' in capsys.readouterr().out


def test_ordered_staging_gives_several_batches_and_drops_nothing(spark, scratch):
    from orderlens.sources.topic import stage_topic_in_order

    records = fixtures.order_topic(spark, SF_SMALL)
    source = stage_topic_in_order(records, f"{scratch}/topic", slices=4)
    progress = []
    got = run_window_revenue(spark, source, f"{scratch}/log", f"{scratch}/ckpt", max_files_per_trigger=1, progress=progress)
    batches = [p for p in progress if p["numInputRows"] > 0]
    dropped = sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])
    assert len(batches) == 4 and dropped == 0
    want = window_revenue(clean_orders(records))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_publish_stages_keyed_records_from_batch_and_stream(spark, scratch):
    from orderlens.sinks.writers import publish
    from orderlens.sources.topic import stage_topic
    from orderlens.operators.decode import decode_orders

    events = fixtures.order_events(spark, SF_SMALL)
    publish(events, "orders.raw", path=f"{scratch}/batch")
    stream = decode_orders(file_topic_stream(spark, stage_topic(fixtures.order_topic(spark, SF_SMALL), f"{scratch}/in")))
    publish(stream.select(events.columns), "orders.raw", path=f"{scratch}/stream", checkpoint=f"{scratch}/c",
            available_now=True).awaitTermination()
    rows = [sorted(map(tuple, spark.read.parquet(f"{scratch}/{x}").collect())) for x in ("batch", "stream")]
    assert rows[0] == rows[1] and len(rows[0]) == events.count() and {r[2] for r in rows[0]} == {"orders.raw"}


def test_rejects_of_a_replayed_batch_are_kept_once(spark, scratch):
    from orderlens.sources.topic import stage_topic
    from orderlens.streaming.pipeline import start_warehouse_load

    source = stage_topic(fixtures.mixed_topic(spark, SF_SMALL), f"{scratch}/topic")
    counts = []
    for ckpt in ("a", "b"):  # a new checkpoint numbers its batches anew: the same deliveries again
        start_warehouse_load(file_topic_stream(spark, source), f"{scratch}/raw", f"{scratch}/{ckpt}", rejects=f"{scratch}/rejects",
                             available_now=True).awaitTermination()
        rejects = spark.read.parquet(f"{scratch}/rejects")
        counts.append((rejects.count(), spark.read.parquet(f"{scratch}/raw").count()))
    assert counts[0] == counts[1] and counts[0][0] > 0
    assert {r.violations for r in rejects.select("violations").distinct().collect()} == {"amount_unfit"}
