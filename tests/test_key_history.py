"""The target's keys pass a sieve of the batch's keys before anything is shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from orderlens.operators import load
from orderlens.sources import fixtures
from tests.conftest import SF_SMALL


def keys(df):
    return {r[0] for r in df.select("order_id").collect()}


def test_sieve_keeps_every_key_of_the_batch_and_few_others(spark):
    target = spark.range(0, 200_000).select(F.concat(F.lit("k"), "id").alias("order_id"))
    batch = spark.range(150_000, 200_500).select(F.concat(F.lit("k"), "id").alias("order_id"))
    got = keys(load.sieved_keys(target, batch, "order_id"))
    assert {f"k{i}" for i in range(150_000, 200_000)} <= got
    assert len(got) < 50_000 + 150_000 * 0.1


def test_sieve_of_nulls_and_of_nothing(spark):
    target = spark.createDataFrame([("a",), (None,), ("b",)], "order_id string")
    assert keys(load.sieved_keys(target, target.where("order_id IS NULL"), "order_id")) == set()
    assert keys(load.sieved_keys(target, target.limit(0), "order_id")) == set()
    assert keys(load.sieved_keys(target, target.where("order_id = 'b'"), "order_id")) <= {"a", "b"}


def test_sieve_of_other_key_types(spark):
    target, batch = spark.range(1000).toDF("order_id"), spark.range(990, 1010).toDF("order_id")
    assert {*range(990, 1000)} <= keys(load.sieved_keys(target, batch, "order_id"))


def test_sieve_size_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(load, "SIEVE_MOST", 1 << 21)
    sieve, bits = load.key_sieve(spark.range(1_000_000).toDF("order_id"), "order_id")
    assert bits == 1 << 21 and sieve.agg(F.sum(F.octet_length("bits"))).first()[0] <= (1 << 21) // 8


def test_what_is_shuffled_follows_the_batch(spark, scratch):
    """The join's exchange lies above the sieve: of a large target only the batch's keys are shuffled."""
    target = spark.range(0, 300_000).select(F.concat(F.lit("k"), "id").alias("order_id"), F.lit(1).alias("amount"))
    target.write.parquet(f"{scratch}/raw")
    batch = spark.range(299_900, 300_100).select(F.concat(F.lit("k"), "id").alias("order_id"), F.lit(1).alias("amount"))
    known = load.known_keys(spark.read.parquet(f"{scratch}/raw"), batch, "order_id")
    assert 100 <= known.count() < 100 + 300_000 * 0.01
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"(?<!Broadcast)Exchange hashpartitioning\(order_id", plan)
    fresh = load.new_rows(batch, known)
    assert keys(fresh) == {f"k{i}" for i in range(300_000, 300_100)}
    assert load.insert_if_absent(spark, batch, f"{scratch}/raw") == 100
    assert load.insert_if_absent(spark, batch, f"{scratch}/raw") == 0


def test_only_the_batch_days_are_read(spark, scratch):
    raw = fixtures.raw_orders(spark, SF_SMALL).filter("year = 1995")
    load.insert_if_absent(spark, raw.filter("month <= 6"), f"{scratch}/raw", partition_by=load.RAW_LAYOUT)
    batch = raw.filter("month = 6 AND day <= 3 OR month = 7 AND day <= 9")
    target = spark.read.parquet(f"{scratch}/raw")
    known = load.known_keys(target, batch, "order_id", load.RAW_LAYOUT)
    read = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in read and "year" in read.split("PartitionFilters: [")[1].split("]")[0]
    inserted = load.insert_if_absent(spark, batch, f"{scratch}/raw", key_in_one_partition=True)
    assert inserted == batch.filter("month = 7").select("order_id").distinct().count() > 0
    assert load.insert_if_absent(spark, batch, f"{scratch}/raw", key_in_one_partition=True) == 0


@pytest.mark.parametrize("columns", [["p"], ["p", "q"]])
def test_batch_partitions_with_nulls(spark, columns):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, None), (4, 4)], "p int, q int")
    some = df.filter("p IS NULL OR p = 3")
    got = df.filter(load.batch_partitions(some, columns))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, some.collect()), key=repr)


def test_too_many_partitions_give_no_predicate(spark, monkeypatch):
    monkeypatch.setattr(load, "MOST_PARTITIONS", 3)
    assert load.batch_partitions(spark.range(4).toDF("p"), ["p"]) is None
    assert load.batch_partitions(spark.range(3).toDF("p"), ["p"]) is not None


def test_a_new_target_is_no_error(spark, scratch, capfd):
    assert load.target_layout(spark, f"{scratch}/none") is None
    assert "Exception" not in capfd.readouterr().err


def test_a_known_batch_is_not_read_again_and_new_keys_are_found(spark, scratch):
    """The batch's plan runs once for its keys; whole rows are read only for new ones."""
    def counted(df):
        seen = spark.sparkContext.accumulator(0)

        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return seen, df.mapInArrow(run, df.schema)

    target = spark.range(0, 400_000).selectExpr("concat('k', id) AS order_id", "1 AS amount")
    load.insert_if_absent(spark, target, f"{scratch}/raw")
    seen, again = counted(target)
    assert load.insert_if_absent(spark, again, f"{scratch}/raw") == 0 and seen.value == 400_000
    mixed = spark.createDataFrame([("k1", 2), ("x", 2), ("x", 1), (None, 3)], "order_id string, amount int")
    assert load.insert_if_absent(spark, mixed, f"{scratch}/raw") == 1
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/raw").filter("order_id = 'x'").collect()] == [("x", 1)]
