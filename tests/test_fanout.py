"""The one-read fan-out: rows of the three outputs, one scan, restarts between outputs, late data, merges."""

import pytest
from pyspark.sql import functions as F

from orderlens.config import FraudRule
from orderlens.plans.order_flow import alert_rows, clean_orders, lake_rows
from orderlens.sinks.writers import alert_payload
from orderlens.sources import fixtures
from orderlens.sources.topic_log import append_topic, drain, topic_stream
from orderlens.streaming import fanout
from orderlens.streaming.pipeline import no_pause, run_window_revenue
from orderlens.streaming.windows import window_revenue
from tests.conftest import SF_SMALL

RULE = FraudRule(100.0, 30)


@pytest.fixture()
def records(spark):
    return fixtures.order_topic(spark, SF_SMALL)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def start(spark, path, paths, sink=None, cap=250, **more):
    return fanout.start_fanout(topic_stream(spark, path, paths.checkpoint, "earliest", max_offsets=cap), paths, RULE, no_pause(), sink=sink, **more)


def check(spark, records, paths):
    """Every output holds each row once, as the batch plans give it."""
    assert rows(fanout.lake_orders(spark, paths).drop("batch_id")) == rows(lake_rows(records, RULE))
    assert rows(fanout.alerts(spark, paths).select("value")) == rows(alert_payload(alert_rows(records, RULE)))
    assert rows(fanout.window_totals(spark, paths)) == rows(window_revenue(clean_orders(records)))


def test_three_outputs_from_one_scan(spark, records, scratch):
    path, paths = append_topic(records, f"{scratch}/t"), fanout.FanoutPaths.below(f"{scratch}/out")
    reports = [p for p in drain(start(spark, path, paths)) if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in reports) == records.count() and len(reports) >= 4
    check(spark, records, paths)
    marks = fanout.marks(spark, paths).agg(F.sum("orders"), F.sum("lake_rows") + F.sum("alert_rows"), F.sum("late_rows")).first()
    assert tuple(marks) == (clean_orders(records).count(), clean_orders(records).count(), 0)


@pytest.mark.parametrize("step", ["write_alerts", "write_mark"])
def test_a_crash_between_outputs_loses_and_repeats_nothing(spark, records, scratch, step):
    path, paths = append_topic(records, f"{scratch}/t"), fanout.FanoutPaths.below(f"{scratch}/out")

    class Crashing(fanout.Fanout):
        pass

    def fail(self, rows, batch_id, *rest):
        if batch_id == 2:
            raise RuntimeError("lost between two outputs")
        return getattr(fanout.Fanout, step)(self, rows, batch_id, *rest)

    setattr(Crashing, step, fail)
    query = start(spark, path, paths, Crashing(paths, no_pause()))
    with pytest.raises(Exception, match="lost between two outputs"):
        query.processAllAvailable()
    assert fanout.last_marked(spark, paths) == 1
    seen = fanout.lake_orders(spark, paths)
    assert {r[0] for r in seen.select("batch_id").distinct().collect()} == {0, 1}  # the unfinished batch is not shown
    drain(start(spark, path, paths))
    check(spark, records, paths)


def test_late_rows_are_dropped_as_by_the_stateful_stream(spark, records, scratch):
    early = records.filter("timestamp < '2024-01-20' AND offset % 10 <> 0")
    later = records.filter("timestamp >= '2024-01-20' AND offset % 10 <> 0")
    path, paths = f"{scratch}/t", fanout.FanoutPaths.below(f"{scratch}/out")
    for part in (early, later, records.filter("offset % 10 = 0")):
        append_topic(part, path)
    drain(fanout.start_fanout(topic_stream(spark, path, paths.checkpoint, "earliest", max_appends=1), paths, RULE, no_pause(), merge_every=1))
    state = run_window_revenue(spark, topic_stream(spark, path, f"{scratch}/c", "earliest", max_appends=1), f"{scratch}/log", f"{scratch}/c")
    got = fanout.window_totals(spark, paths)
    assert rows(got) == rows(state) and got.count() < window_revenue(clean_orders(records)).count()
    late = fanout.marks(spark, paths).agg(F.sum("late_rows")).first()[0]
    assert late == clean_orders(records).count() - got.agg(F.sum("order_count")).first()[0] > 0
    assert fanout.lake_orders(spark, paths).count() == lake_rows(records, RULE).count()


def test_merges_bound_what_live_windows_cost(spark, records, scratch):
    records = records.withColumn("partition", F.lit(0))  # small batches, so one order of time
    path, paths = append_topic(records, f"{scratch}/t"), fanout.FanoutPaths.below(f"{scratch}/out")
    drain(start(spark, path, paths, merge_every=2, cap=records.count() // 6))
    check(spark, records, paths)
    log = fanout.window_log(spark, paths)
    merged = log.pointer()
    assert merged.generation >= 1 and len(log._unmerged(merged, None)) < 2
    late = fanout.marks(spark, paths).where(F.col("batch_id") == merged.upto).first().late_before
    live = log.live(merged.upto)
    assert live.count() < fanout.window_totals(spark, paths).count()
    assert live.where(F.col("window_end") <= F.lit(late)).count() == 0
