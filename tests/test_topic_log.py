"""The topic of files: offsets, bounded reads, admission by offsets, resuming."""

import json
import os
import shutil
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderlens.schemas import TOPIC_RECORD
from orderlens.sources import fixtures
from orderlens.sources.topic_log import _index, _ranges, admitted, append_topic, drain, size, topic_records, topic_stream
from orderlens.streaming.state import quick_checkpoints
from tests.conftest import SF_SMALL


@pytest.fixture()
def records(spark):
    return fixtures.order_topic(spark, SF_SMALL)


def _sink(stream, out, checkpoint):
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()


def test_offsets_are_dense_and_follow_time(spark, records, scratch):
    append_topic(records, f"{scratch}/t", segment_rows=40, files=3)
    got = topic_records(spark, f"{scratch}/t")
    assert got.schema == TOPIC_RECORD and size(f"{scratch}/t") == records.count()
    want = {}
    for r in records.orderBy("partition", "timestamp", "offset").collect():
        want.setdefault(r.partition, []).append((r.key, r.value, r.topic, r.timestamp, r.timestampType))
    have = {}
    for r in got.orderBy("partition", "offset").collect():
        rows = have.setdefault(r.partition, [])
        assert r.offset == len(rows)
        rows.append((r.key, r.value, r.topic, r.timestamp, r.timestampType))
    assert have == want
    assert len({r["file"] for r in _index(f"{scratch}/t")}) >= records.count() / 40


def test_an_append_goes_on_where_the_topic_ends(spark, records, scratch):
    for part in ("offset % 2 = 0", "offset % 2 = 1"):
        append_topic(records.filter(part), f"{scratch}/t")
    got = topic_records(spark, f"{scratch}/t").withColumn("odd", F.get_json_object(F.col("value").cast("string"), "$.order_id").substr(5, 20).cast("long") % 2)
    ends = {r.partition: (r.n, r.last) for r in got.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last")).collect()}
    assert all(n == last + 1 for n, last in ends.values())
    assert got.groupBy("partition").agg((F.max(F.when(F.col("odd") == 0, F.col("offset"))) < F.min(F.when(F.col("odd") == 1, F.col("offset")))).alias("ok")).where("NOT ok").count() == 0


def test_bounded_reads_by_offsets(spark, records, scratch):
    path = append_topic(records, f"{scratch}/t", segment_rows=50)
    some = topic_records(spark, path, json.dumps({"0": 10, "1": 5}), json.dumps({"0": 30, "1": 6, "2": 0}))
    assert sorted((r.partition, r.offset) for r in some.collect()) == [(0, x) for x in range(10, 30)] + [(1, 5)]
    before = topic_records(spark, path).agg(F.count(F.lit(1)))
    assert before.first()[0] == records.count()


def test_the_first_messages_plan_no_other_ranges(spark, records, scratch):
    path = append_topic(records, f"{scratch}/t", segment_rows=20)
    few = topic_records(spark, path, max_messages=25)
    assert few.count() == 25 and few.rdd.getNumPartitions() == 2
    assert topic_records(spark, path).rdd.getNumPartitions() == len(_index(path))
    assert topic_records(spark, path, max_messages=0).count() == 0


def test_ranges_are_cut_to_a_task_and_to_the_segments():
    index = [{"file": "a", "partition": 0, "first_row": 7, "rows": 10, "first_offset": 0}, {"file": "b", "partition": 0, "first_row": 0, "rows": 10, "first_offset": 10}]
    got = [(r.file, r.first_row, r.rows, r.first_offset) for r in _ranges(index, {"0": 3}, {"0": 15}, 4)]
    assert got == [("a", 10, 4, 3), ("a", 14, 3, 7), ("b", 0, 4, 10), ("b", 4, 1, 14)]


def test_admission_shares_the_cap_and_loses_nothing():
    assert admitted({"0": 5}, {"0": 10, "1": 3}, 0) == {"0": 10, "1": 3}
    at, ends, steps = {}, {"0": 1000, "1": 10, "2": 0}, 0
    while at != ends:
        new = admitted(at, ends, 100)
        assert 0 < sum(new.values()) - sum(at.values()) <= 100 and all(new[p] >= at.get(p, 0) for p in new)
        at, steps = new, steps + 1
    assert steps == 11


def test_stream_starts_at_the_latest_and_is_capped(spark, records, scratch):
    path = append_topic(records.filter("offset < 100"), f"{scratch}/t")
    query = _sink(topic_stream(spark, path, f"{scratch}/c", max_offsets=30), f"{scratch}/out", f"{scratch}/c")
    query.processAllAvailable()
    new = records.filter("offset >= 100")
    append_topic(new, path)
    reports = drain(query)
    sizes = [p["numInputRows"] for p in reports if p["numInputRows"]]
    assert sum(sizes) == new.count() and set(sizes[:-1]) == {30} and sizes[-1] <= 30
    got = spark.read.parquet(f"{scratch}/out")
    assert sorted(r.value for r in got.collect()) == sorted(r.value for r in new.collect())


def test_a_stopped_stream_resumes_from_its_checkpoint(spark, records, scratch):
    path = append_topic(records, f"{scratch}/t")
    total, done = records.count(), 0
    for _ in range(2):
        query = _sink(topic_stream(spark, path, f"{scratch}/c", "earliest", max_offsets=total // 5), f"{scratch}/out", f"{scratch}/c")
        while query.isActive and not query.recentProgress:
            query.awaitTermination(1)
        query.stop()
        now = spark.read.parquet(f"{scratch}/out").count()
        assert now > done
        done = now
    drain(_sink(topic_stream(spark, path, f"{scratch}/c", "earliest", max_offsets=total // 5), f"{scratch}/out", f"{scratch}/c"))
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() == total == got.select("partition", "offset").distinct().count()


def test_appends_are_admitted_one_by_one(spark, records, scratch):
    path = f"{scratch}/t"
    shares = [records.filter(f"offset % 3 = {k}") for k in range(3)]
    for share in shares:
        append_topic(share, path)
    reports = drain(_sink(topic_stream(spark, path, f"{scratch}/c", "earliest", max_appends=1), f"{scratch}/out", f"{scratch}/c"))
    assert [p["numInputRows"] for p in reports if p["numInputRows"]] == [s.count() for s in shares]


def test_a_capped_stream_needs_its_checkpoint(spark, records, scratch):
    path = append_topic(records, f"{scratch}/t")
    with pytest.raises(Exception, match="checkpointLocation"):
        topic_stream(spark, path, max_offsets=5).writeStream.format("noop").option("checkpointLocation", f"{scratch}/c").start().processAllAvailable()


def test_the_index_is_read_while_an_append_is_under_way(spark, records, scratch):
    path, done = append_topic(records, f"{scratch}/t"), threading.Event()
    want = _index(path)

    def come_and_go():
        while not done.is_set():
            for k in range(20):
                os.makedirs(f"{path}/index/_temporary/0/{k}")
            shutil.rmtree(f"{path}/index/_temporary")

    other = threading.Thread(target=come_and_go)
    other.start()
    try:
        assert all(_index(path) == want for _ in range(300))
    finally:
        done.set()
        other.join()


def test_small_micro_batches_start_no_python_worker(spark, records, scratch):
    from orderlens.sources.topic_log import PLANNED_ROWS, StagedTopic, _SmallBatches, _Stream
    from pyspark.sql.datasource_internal import _SimpleStreamReaderWrapper, _streamReader

    path = append_topic(records, f"{scratch}/t")
    options = {"path": path, "startingOffsets": "earliest", "checkpointLocation": f"{scratch}/c"}
    reader = lambda most, small: _streamReader(StagedTopic({**options, "maxOffsetsPerTrigger": str(most), "readWhenAdmitted": small}), TOPIC_RECORD)
    small = reader(30, "true")
    assert isinstance(small, _SimpleStreamReaderWrapper) and isinstance(small.simple_reader, _SmallBatches)
    assert all(isinstance(x, _Stream) for x in (reader(30, "false"), reader(0, "true"), reader(PLANNED_ROWS + 1, "true")))
    at, seen = small.initialOffset(), []
    for _ in range(3):
        end = small.latestOffset()
        small.partitions(at, end)
        rows = [(r["partition"], r["offset"]) for b in small.getCache(at, end) for r in b.to_pylist()]
        assert len(rows) == 30 and rows == [(r["partition"], r["offset"]) for b in small.simple_reader.readBetweenOffsets(at, end) for r in b.to_pylist()]
        seen += rows
        small.commit(end)
        at = end
    assert len(set(seen)) == 90


def test_an_unfinished_small_micro_batch_is_done_again(spark, records, scratch):
    path, checkpoint = append_topic(records, f"{scratch}/t"), f"{scratch}/c"
    fails = [True]

    def keep(batch, batch_id):
        if batch_id == 2 and fails:
            fails.pop()
            raise RuntimeError("once")
        batch.write.mode("overwrite").parquet(f"{scratch}/out/batch={batch_id}")

    def start():
        with quick_checkpoints(spark, checkpoint):
            return topic_stream(spark, path, checkpoint, "earliest", max_offsets=30, small=True).writeStream.foreachBatch(keep).option(
                "checkpointLocation", checkpoint).start()

    with pytest.raises(Exception, match="once"):
        drain(start())
    drain(start())
    got, total = spark.read.parquet(f"{scratch}/out"), records.count()
    assert got.count() == total == got.select("partition", "offset").distinct().count()
    sizes = {r["batch"]: r["count"] for r in got.groupBy("batch").count().collect()}
    assert sizes == {k: min(30, total - 30 * k) for k in range(-(-total // 30))}
    assert spark.conf.get("spark.sql.streaming.checkpointFileManagerClass", None) is None


def test_an_empty_topic_streams_nothing(spark, scratch):
    drain(_sink(topic_stream(spark, f"{scratch}/none", f"{scratch}/c", "earliest"), f"{scratch}/out", f"{scratch}/c"))
    assert size(f"{scratch}/none") == 0 and topic_records(spark, f"{scratch}/none").count() == 0


def test_a_small_range_decodes_few_rows(spark, scratch):
    """Row groups are small and reading ends with the range; a large group was decoded whole for every micro-batch."""
    rows = spark.range(60_000).selectExpr("cast(cast(id as string) as binary) key", "cast(repeat(sha2(cast(id as string), 256), 4) as binary) value", "'t' topic",
                                          "0 partition", "id offset", "timestamp_seconds(id) timestamp", "0 timestampType")
    path = append_topic(rows, f"{scratch}/t", files=1)
    file = _index(path)[0]["file"].removeprefix("file:")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 4 and max(meta.row_group(g).num_rows for g in range(meta.num_row_groups)) < 20_000
    some = topic_records(spark, path, json.dumps({"0": 31_000}), json.dumps({"0": 32_000}))
    assert sorted(r.offset for r in some.collect()) == list(range(31_000, 32_000))
