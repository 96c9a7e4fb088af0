"""Load path: gate, insert-if-absent idempotence, lake scans, lineage, pruning, sinks."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from orderlens.operators import conform, load
from orderlens.plans import order_flow
from orderlens.plans.load_job import load_lake
from orderlens.schemas import RAW_ORDERS
from orderlens.sinks import writers
from orderlens.sources import fixtures
from orderlens.sources.files import footer_counts, list_files, load_summary, scan_range, scan_valid, whole_files
from tests.conftest import SF_SMALL


def _raw_row(oid, **kw):
    base = dict(order_id=oid, customer_id="c1", product_id="p1", product_name="n", category="books",
                price=Decimal("1.00"), quantity=1, amount=Decimal("10.00"),
                order_timestamp=dt.datetime(2024, 1, 1, 10), customer_age_days=5, is_fraud=False,
                fraud_reason=None, year=2024, month=1, day=1, loaded_at=dt.datetime(2024, 1, 2),
                source_file="f1")
    base.update(kw)
    return tuple(base[f.name] for f in RAW_ORDERS.fields)


def test_constraint_gate_reasons(spark):
    rows = [_raw_row("ok"), _raw_row("neg", amount=Decimal("-1.00"), quantity=0),
            _raw_row(None), _raw_row("nullcheck", price=None)]
    df = spark.createDataFrame(rows, RAW_ORDERS)
    got = {r.order_id: r.violations for r in load.constraint_gate(df).collect()}
    assert got["ok"] is None and got["nullcheck"] is None  # CHECK passes on NULL
    assert got["neg"] == "quantity_positive,amount_non_negative"
    assert got[None] == "order_id_not_null"
    accepted, rejected = load.split_gate(df)
    assert accepted.count() == 2 and rejected.count() == 2


def test_insert_if_absent_first_arrival_and_idempotent(spark, scratch):
    target = f"{scratch}/target"
    rows = [_raw_row("a", amount=Decimal("5.00"), source_file="f2"),
            _raw_row("a", amount=Decimal("9.00"), source_file="f1"),
            _raw_row("b"), _raw_row(None)]
    batch = spark.createDataFrame(rows, RAW_ORDERS)
    assert load.insert_if_absent(spark, batch, target) == 2
    assert load.insert_if_absent(spark, batch, target) == 0
    got = {r.order_id: r for r in spark.read.parquet(target).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].source_file == "f1"  # earlier file wins
    more = spark.createDataFrame([_raw_row("c"), _raw_row("a", source_file="f0")], RAW_ORDERS)
    assert load.insert_if_absent(spark, more, target) == 1


def test_fixture_dedup_count(spark, scratch):
    raw = fixtures.raw_orders(spark, SF_SMALL)
    n_keys = raw.select("order_id").distinct().count()
    assert load.insert_if_absent(spark, raw, f"{scratch}/t") == n_keys


def test_conform_pads_and_renames(spark):
    flagged = order_flow.flagged_orders(fixtures.order_topic(spark, SF_SMALL), fixtures.F1_RULE)
    out = conform.to_warehouse(flagged)
    assert out.columns == [f.name for f in RAW_ORDERS.fields if f.name != "loaded_at"]
    row = out.first()
    assert row.product_id is None and row.category is not None and row.year == 2024


def test_lake_scan_lineage_limits_and_bad_files(spark, scratch):
    lake = f"{scratch}/lake"
    rows = order_flow.lake_rows(fixtures.order_topic(spark, SF_SMALL), fixtures.F1_RULE)
    writers.write_partitioned(rows, lake)
    # a corrupt file and a non-parquet file inside the layout
    day = sorted(d for d in os.listdir(f"{lake}/year=2024/month=1") if d.startswith("day="))[0]
    with open(f"{lake}/year=2024/month=1/{day}/zz-corrupt.parquet", "wb") as fh:
        fh.write(b"not parquet")
    with open(f"{lake}/year=2024/month=1/{day}/notes.txt", "w") as fh:
        fh.write("x")
    with pytest.raises(Exception, match="zz-corrupt"):
        scan_valid(spark, lake).count()  # never silently
    scanned = scan_valid(spark, lake, lineage=True, ignore_corrupt=True)
    assert scanned.count() == rows.count()
    assert scanned.filter(F.col("source_file").contains("zz-corrupt")).count() == 0
    assert set(scanned.columns) >= {"year", "month", "day", "source_file", "row_index", "loaded_at"}
    summary = load_summary(scanned, list_files(spark, lake))
    assert summary.filter("failed").count() == 1  # the corrupt file produced no rows
    first_two = scan_valid(spark, lake, limit_files=2)
    assert len(first_two.inputFiles()) == 2


def test_range_scan_prunes_partitions(spark, scratch):
    lake = f"{scratch}/lake"
    writers.write_partitioned(order_flow.lake_rows(fixtures.order_topic(spark, SF_SMALL), fixtures.F1_RULE),
                              lake, cluster_by="event_time")
    df = scan_range(scan_valid(spark, lake), dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "isnotnull(year" in plan
    days = {r.day for r in df.select("day").distinct().collect()}
    assert days <= {10, 11}
    assert df.count() == scan_valid(spark, lake).filter(
        (F.col("event_time") >= "2024-01-10") & (F.col("event_time") < "2024-01-12")).count()


def test_load_job_end_to_end(spark, scratch):
    lake = f"{scratch}/lake"
    writers.write_partitioned(order_flow.lake_rows(fixtures.order_topic(spark, SF_SMALL), fixtures.F1_RULE), lake)
    res = load_lake(spark, lake, f"{scratch}/raw")
    n = scan_valid(spark, lake).count()
    assert res.inserted == n and res.rejected.count() == 0
    assert res.totals.first().total_rows == n
    assert load_lake(spark, lake, f"{scratch}/raw").inserted == 0


def test_catalog_sinks(spark, scratch):
    writers.create_layers(spark, ("raw", "analytics", "test_results"))
    writers.create_raw_orders_table(spark, "raw.orders")
    spark.sql("INSERT INTO raw.orders (order_id, customer_id, product_id, order_timestamp, year, month, day) "
              "VALUES ('o1', 'c1', 'p1', timestamp'2024-01-01 00:00:00', 2024, 1, 1)")
    assert spark.table("raw.orders").first().loaded_at is not None  # column default
    writers.analyze(spark, "raw.orders")
    df = spark.range(3).withColumnRenamed("id", "x")
    writers.materialize_table(spark, df, "analytics.t")
    writers.materialize_table(spark, spark.table("analytics.t").withColumn("x", F.col("x") + 10), "analytics.t")
    assert sorted(r.x for r in spark.table("analytics.t").collect()) == [10, 11, 12]
    writers.refresh_rollup(spark, df, "analytics.rollup")
    writers.refresh_rollup(spark, df.limit(1), "analytics.rollup")
    assert spark.table("analytics.rollup").count() == 1
    writers.store_failures(df.filter("x > 0"), "some_check")
    assert spark.table("test_results.some_check").count() == 2
    writers.materialize_view(df, "v_model")
    assert spark.table("v_model").count() == 3
    w = writers.jdbc_writer(df, "jdbc:postgresql://db/x", "raw.orders", {"user": "u"})
    assert w is not None


def test_hot_key_dedup_is_exact(spark, scratch):
    """One order id holding a third of the batch still yields exactly one row, the first arrival."""
    rows = [_raw_row("hot", amount=Decimal(f"{i}.00"), source_file=f"f{i:04d}") for i in range(300)]
    rows += [_raw_row(f"k{i}") for i in range(600)]
    batch = spark.createDataFrame(rows, RAW_ORDERS).repartition(8)
    first = {r.order_id: r for r in load.first_arrival(batch).collect()}
    assert len(first) == 601
    assert first["hot"].source_file == "f0000" and first["hot"].amount == Decimal("0.00")


def test_insert_into_bucketed_table_shuffles_only_the_batch(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    spark.sql("DROP TABLE IF EXISTS raw.orders_bucketed")
    raw = fixtures.raw_orders(spark, SF_SMALL)
    n_keys = raw.select("order_id").distinct().count()
    assert load.insert_if_absent_table(spark, raw, "raw.orders_bucketed", buckets=8) == n_keys
    assert load.insert_if_absent_table(spark, raw, "raw.orders_bucketed", buckets=8) == 0
    assert spark.table("raw.orders_bucketed").count() == n_keys
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = load.new_rows(raw, spark.table("raw.orders_bucketed").select("order_id"))
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    target_side = text.split("LeftAnti")[1]
    scan = [ln for ln in target_side.splitlines() if "orders_bucketed" in ln][0]
    assert "SelectedBucketsCount: 8 out of 8" in scan
    # the target scan feeds the join directly: no exchange between them
    idx = [i for i, ln in enumerate(text.splitlines()) if "orders_bucketed" in ln][0]
    above = text.splitlines()[idx - 1]
    assert "Exchange" not in above


def test_scratch_goes_below_the_session_checkpoint_dir(spark):
    from orderlens.session import scratch_path, work_dir

    ckpt = spark.sparkContext.getCheckpointDir()
    assert ckpt and work_dir(spark) == ckpt.rstrip("/")
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a.startswith(ckpt.rstrip("/") + "/") and a != b


def test_declared_tables_filled_from_contracts(spark):
    from orderlens.operators import marts, staging
    from orderlens.plans.queries import HIGH_VALUE_THRESHOLD

    names = writers.create_warehouse_tables(spark)
    assert set(names) == {"raw.orders", "staging.stg_orders", "analytics.daily_revenue", "analytics.customer_metrics"}
    stg = staging.stg_orders(fixtures.raw_orders(spark, SF_SMALL))
    writers.load_declared(marts.daily_revenue_contract(stg), "analytics.daily_revenue")
    writers.load_declared(marts.customer_metrics_contract(stg, HIGH_VALUE_THRESHOLD), "analytics.customer_metrics")
    daily = spark.table("analytics.daily_revenue")
    assert daily.count() == marts.daily_revenue_contract(stg).count()
    assert daily.filter("created_at IS NULL").count() == 0
    assert spark.table("analytics.customer_metrics").filter("updated_at IS NULL").count() == 0
    gated, _ = load.split_gate(fixtures.raw_orders(spark, SF_SMALL))
    writers.load_declared(load.first_arrival(gated.drop("year", "month", "day", "loaded_at", "source_file")),
                          "staging.stg_orders")
    assert spark.table("staging.stg_orders").select("order_id").distinct().count() == \
        spark.table("staging.stg_orders").count()


def test_gate_rejects_over_width_keys(spark):
    df = spark.createDataFrame([_raw_row("x" * 51), _raw_row("ok")], RAW_ORDERS)
    got = {r.order_id: r.violations for r in load.constraint_gate(df).collect()}
    assert got["x" * 51] == "order_id_width" and got["ok"] is None


def test_staging_distinct_reuses_a_bucketed_raw_table(spark):
    from orderlens.operators import staging

    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    spark.sql("DROP TABLE IF EXISTS raw.orders_by_key")
    load.insert_if_absent_table(spark, fixtures.raw_orders(spark, SF_SMALL), "raw.orders_by_key", buckets=8)
    stg = staging.stg_orders(spark.table("raw.orders_by_key"))
    plan = stg._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the distinct runs inside the key buckets
    dups = spark.table("raw.orders_by_key").groupBy("order_id").count()
    assert "Exchange" not in dups._jdf.queryExecution().executedPlan().toString()


def test_load_job_into_bucketed_table(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    spark.sql("DROP TABLE IF EXISTS raw.orders_loaded")
    lake = f"{scratch}/lake"
    writers.write_partitioned(order_flow.lake_rows(fixtures.order_topic(spark, SF_SMALL), fixtures.F1_RULE), lake)
    res = load_lake(spark, lake, target_table="raw.orders_loaded", buckets=4)
    assert res.inserted == scan_valid(spark, lake).count() == res.totals.first().total_rows
    assert load_lake(spark, lake, target_table="raw.orders_loaded", buckets=4).inserted == 0


def test_partitioned_bucketed_table_keeps_both_layouts(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    spark.sql("DROP TABLE IF EXISTS raw.orders_pb")
    raw = fixtures.raw_orders(spark, SF_SMALL)
    n = load.insert_if_absent_table(spark, raw, "raw.orders_pb", buckets=8, partition_by=["year", "month", "day"])
    assert n == raw.select("order_id").distinct().count()
    more = raw.withColumn("order_id", F.concat(F.col("order_id"), F.lit("-b")))
    assert load.insert_if_absent_table(spark, more, "raw.orders_pb", buckets=8,
                                       partition_by=["year", "month", "day"]) == n
    t = spark.table("raw.orders_pb")
    assert t.count() == 2 * n
    pruned = t.filter("year = 1995")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = load.new_rows(raw, t.select("order_id"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = [ln for ln in plan.splitlines() if "orders_pb" in ln][0]
    assert "SelectedBucketsCount: 8 out of 8" in scan


def _damaged_copy(path: str, share: float) -> str:
    """A copy of the file whose bytes from this share on, up to its footer, are overwritten."""
    with open(path, "rb") as fh:
        data = bytearray(fh.read())
    end = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
    start = int(len(data) * share)
    data[start:end] = b"\x07" * max(0, end - start)
    copy = os.path.join(os.path.dirname(path), "zz-damaged.parquet")
    with open(copy, "wb") as fh:
        fh.write(data)
    return copy


def test_partly_damaged_file_is_dropped_whole_and_listed(spark, scratch):
    lake = f"{scratch}/lake"
    rows = order_flow.lake_rows(fixtures.order_topic(spark, SF_SMALL), fixtures.F1_RULE)
    (rows.drop("year", "month", "day").selectExpr("*", "2024 year", "1 month", "1 + (hash(order_id) & 1) day")
     .repartition(2, "day").write.option("parquet.block.size", 4096).option("parquet.page.size", 512)
     .option("parquet.page.row.count.limit", 20).partitionBy("year", "month", "day").parquet(lake))
    n = spark.read.parquet(lake).count()
    files = [r.source_file.replace("file:", "") for r in list_files(spark, lake).orderBy("source_file").collect()]
    other = spark.read.parquet(files[0]).withColumn("order_id", F.concat("order_id", F.lit("-x"))).coalesce(1)
    other.write.parquet(f"{scratch}/other")
    one = next(f"{scratch}/other/{x}" for x in os.listdir(f"{scratch}/other") if x.endswith(".parquet"))
    os.makedirs(f"{lake}/year=2024/month=1/day=3")
    bad = _damaged_copy(one, 0.6).replace(f"{scratch}/other", f"{lake}/year=2024/month=1/day=3")
    with open(f"{scratch}/other/zz-damaged.parquet", "rb") as src, open(bad, "wb") as dst:
        dst.write(src.read())
    res = load_lake(spark, lake, f"{scratch}/raw")
    assert res.inserted == n == spark.read.parquet(f"{scratch}/raw").count()
    failed = {r.source_file.rsplit("/", 1)[-1] for r in res.files.collect() if r.failed}
    assert failed == {"zz-damaged.parquet"}
    from orderlens.plans.load_job import file_totals

    assert tuple(file_totals(res.files).first()) == (len(files) + 1, n, 1)
    scan_valid(spark, lake, lineage=True, ignore_corrupt=True).write.parquet(f"{scratch}/staged")
    staged = spark.read.parquet(f"{scratch}/staged")
    summary = load_summary(staged, list_files(spark, lake), footer_counts(spark, lake))
    assert n < staged.count() + 1 and whole_files(staged, summary).count() == n


def test_batch_and_stream_load_one_layout(spark, scratch):
    """The stream's rows are where a read of the day-partitioned table finds them, also after a second delivery."""
    from orderlens.sources.topic import file_topic_stream, stage_topic
    from orderlens.streaming.pipeline import start_warehouse_load

    records = fixtures.order_topic(spark, SF_SMALL)
    lake, raw = f"{scratch}/lake", f"{scratch}/raw"
    writers.write_partitioned(order_flow.lake_rows(records, fixtures.F1_RULE), lake)
    first = load_lake(spark, lake, raw).inserted
    source = stage_topic(records, f"{scratch}/topic")
    for ckpt in ("c1", "c2"):  # the second checkpoint delivers all batches again
        q = start_warehouse_load(file_topic_stream(spark, source), raw, f"{scratch}/{ckpt}", fixtures.F1_RULE,
                                 rejects=f"{scratch}/rejects", available_now=True)
        q.awaitTermination()
        total = order_flow.clean_orders(records).count()
        assert spark.read.parquet(raw).count() == total > first
    assert load.target_layout(spark, raw) == ("year", "month", "day")
    assert load_lake(spark, lake, raw).inserted == 0


def test_targets_that_do_not_fit_are_refused(spark, scratch):
    batch = spark.createDataFrame([_raw_row("a")], RAW_ORDERS)
    assert load.target_layout(spark, f"{scratch}/none") is None
    batch.drop("order_id").write.parquet(f"{scratch}/no_key")
    with pytest.raises(ValueError, match="no column order_id"):
        load.insert_if_absent(spark, batch, f"{scratch}/no_key")
    load.insert_if_absent(spark, batch, f"{scratch}/flat")
    with pytest.raises(ValueError, match="partitioned by"):
        load.insert_if_absent(spark, batch, f"{scratch}/flat", partition_by=["year"])
    load.insert_if_absent(spark, batch, f"{scratch}/days", partition_by=["year", "day"])
    more = spark.createDataFrame([_raw_row("b")], RAW_ORDERS)
    assert load.insert_if_absent(spark, more, f"{scratch}/days") == 1
    assert spark.read.parquet(f"{scratch}/days").count() == 2


def test_first_arrival_in_a_file_follows_the_rows(spark):
    rows = [(*_raw_row("a", product_id=p), i) for i, p in enumerate(("p9", None, "p1"))]
    batch = spark.createDataFrame(rows, StructType([*RAW_ORDERS.fields, StructField("row_index", LongType())]))
    assert load.first_arrival(batch).first().product_id == "p9"


def test_values_that_do_not_fit_are_rejected_with_a_reason(spark):
    events = [("ok", 10.0), ("big", 1e11), ("nan", float("nan")), ("inf", float("inf"))]
    df = spark.createDataFrame(events, "order_id string, amount double").selectExpr(
        "*", "'c' customer_id", "timestamp'2024-01-01 00:00:00' event_time", "'p' product_id")
    rows = conform.to_warehouse(df, columns=RAW_ORDERS.fieldNames()[:17], unfit=True)
    accepted, rejected = load.split_gate(rows, not_null=load.RAW_NOT_NULL, checks=load.CHECKS + load.WIDTHS)
    assert [r.order_id for r in accepted.collect()] == ["ok"]
    assert {r.order_id: r.violations for r in rejected.collect()} == dict.fromkeys(("big", "nan", "inf"), "amount_unfit")


def test_gate_checks_all_declared_widths(spark):
    row = _raw_row("a", product_name="x" * 256, category="x" * 101, fraud_reason="x" * 256, source_file="x" * 501)
    got = load.constraint_gate(spark.createDataFrame([row], RAW_ORDERS), checks=load.CHECKS + load.WIDTHS).first()
    assert got.violations == "product_name_width,category_width,fraud_reason_width,source_file_width"


def test_bad_rows_are_numbered_without_taking_keys_apart(spark):
    """Filters repeat the number in every column they read; splitting the order id there took most of the time."""
    _, rejected = load.split_gate(fixtures.mixed_raw_orders(spark, SF_SMALL))
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan
    keyed = fixtures.raw_orders(spark, SF_SMALL).selectExpr("(split(order_id, '-')[0] * 7L + split(order_id, '-')[1]) % 60 AS k")
    counts = {r.k: r["count"] for r in keyed.groupBy("k").count().collect()}
    mixed = fixtures.mixed_raw_orders(spark, SF_SMALL)
    assert mixed.filter("order_id IS NULL").count() == counts[1] and mixed.filter("quantity = 0").count() == counts[6]
    assert mixed.count() == sum(counts.values()) + counts[20]
