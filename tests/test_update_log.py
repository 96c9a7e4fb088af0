"""Generations of the update log: merges, crashes around the pointer, replays, readers that began before."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sinks.update_log import UpdateLog
from orderlens.sources.store import names

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])


def add(df):
    return df.groupBy("k").agg(F.sum("v").alias("v"))


@pytest.fixture()
def log(spark, scratch):
    log = UpdateLog(spark, f"{scratch}/log", SCHEMA, add)
    log.put = lambda batch, *rows: log.write(spark.createDataFrame(rows, SCHEMA), batch)
    log.all = lambda upto=None: sorted(map(tuple, log.read(upto).collect()))
    return log


def test_reads_before_and_after_merges_are_equal(log):
    assert log.all() == []
    log.put(0, (1, 10), (2, 5))
    log.put(1, (1, 1), (3, 7))
    assert log.all() == [(1, 11), (2, 5), (3, 7)] and log.all(0) == [(1, 10), (2, 5)]
    log.merge(0, F.lit(False))
    assert log.all() == [(1, 11), (2, 5), (3, 7)]
    log.merge(1, F.col("k") <= 2)
    assert log.all() == [(1, 11), (2, 5), (3, 7)] and sorted(map(tuple, log.live().collect())) == [(3, 7)]
    log.put(2, (3, 1), (4, 1))
    log.merge(2, F.lit(True))
    assert log.all() == [(1, 11), (2, 5), (3, 8), (4, 1)] and log.live().count() == 0


def test_a_replayed_batch_counts_once(log):
    log.put(0, (1, 10))
    log.put(0, (1, 10))
    assert log.all() == [(1, 10)]


@pytest.mark.parametrize("step", ["_point", "_drop_before"])
def test_a_crash_around_the_pointer_is_harmless(log, monkeypatch, step):
    for batch in range(3):
        log.put(batch, (1, 1), (batch + 10, batch))
    log.merge(0, F.lit(False))
    before = log.all()
    with monkeypatch.context() as m:
        m.setattr(UpdateLog, step, lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            log.merge(1, F.col("k") > 5)
    assert log.all() == before
    log.merge(2, F.col("k") > 10)
    assert log.all() == before


def test_old_generations_go_and_the_last_but_one_stays(spark, log):
    for batch in range(5):
        log.put(batch, (batch % 2, 1))
        frame = log.read()  # a reader that begins before the merge
        log.merge(batch, F.lit(False))
        assert frame.count() == min(batch + 1, 2)
    assert len(names(spark, f"{log.root}/live")) == 2 and len(names(spark, f"{log.root}/updates")) == 1
    assert log.all() == [(0, 3), (1, 2)]


def test_nothing_new_is_no_merge(log):
    log.put(0, (1, 1))
    first = log.merge(0, F.lit(False))
    assert log.merge(0, F.lit(False)) == first
