"""Warehouse load: declared-constraint gate (Q13) and insert-if-absent (K5)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.conform import UNFIT
from orderlens.session import scratch_path
from orderlens.sources.store import exists

# The declared constraints of the warehouse order tables
# (name, predicate that must hold): key widths of VARCHAR(50), then the
# CHECKs of the staging table. They pass on NULL, as in SQL.
NOT_NULL = ("order_id", "customer_id", "product_id", "order_timestamp")
# raw.orders as loaded from the stream lake has no product columns yet.
RAW_NOT_NULL = ("order_id", "customer_id", "order_timestamp")
CHECKS = (
    ("order_id_width", "length(order_id) <= 50"),
    ("customer_id_width", "length(customer_id) <= 50"),
    ("product_id_width", "length(product_id) <= 50"),
    ("price_non_negative", "price >= 0"),
    ("quantity_positive", "quantity > 0"),
    ("amount_non_negative", "amount >= 0"),
    ("age_non_negative", "customer_age_days >= 0"),
)
# Declared widths of the remaining text columns of raw.orders.
WIDTHS = (
    ("product_name_width", "length(product_name) <= 255"),
    ("category_width", "length(category) <= 100"),
    ("fraud_reason_width", "length(fraud_reason) <= 255"),
    ("source_file_width", "length(source_file) <= 500"),
)

# First-arrival order of K5: load time, file, row of the file, then the row's own columns.
ARRIVAL_ORDER = ("loaded_at", "source_file", "row_index", "product_id", "amount", "quantity")

# The layout of raw.orders that every load path gives a new target.
RAW_LAYOUT = ("year", "month", "day")
#: Buckets of a new catalog table (about 256 MB each at some TB; the caller's choice beyond).
BUCKETS = 64


def constraint_gate(df: DataFrame, not_null=NOT_NULL, checks=CHECKS) -> DataFrame:
    """Every row with `violations` (comma-separated rule names, NULL if none) and `passed`.

    Row-level rules only; the primary key is enforced by insert_if_absent.
    Values that conforming found not to fit their column (the `UNFIT` column,
    if there is one) count as violations.
    """
    failed = [F.col(UNFIT)] if UNFIT in df.columns else []
    failed += [F.when(F.col(c).isNull(), F.lit(f"{c}_not_null")) for c in not_null if c in df.columns]
    failed += [F.when(~F.coalesce(F.expr(pred), F.lit(True)), F.lit(name)) for name, pred in checks]
    names = F.concat_ws(",", *failed)
    return df.select("*", F.when(names != "", names).alias("violations")).withColumn(
        "passed", F.col("violations").isNull())


def split_gate(df: DataFrame, not_null=NOT_NULL, checks=CHECKS) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the gate columns, rejected rows with their reasons)."""
    gated = constraint_gate(df, not_null, checks)
    accepted = gated.filter(F.col("passed")).drop("violations", "passed", UNFIT)
    rejected = gated.filter(~F.col("passed")).drop("passed", UNFIT)
    return accepted, rejected


def first_arrival(batch: DataFrame, key: str = "order_id", order=ARRIVAL_ORDER) -> DataFrame:
    """One row per key: the smallest by `order`, then by every other column.

    `min` of a struct that leads with the arrival order and carries the rest
    of the row: each task keeps one row per key before the shuffle, so even
    a key holding a third of the batch moves one row per task. The struct
    covers all columns, so the choice is deterministic.
    """
    cols = batch.columns
    ordered = [c for c in order if c in cols] + [c for c in cols if c not in order and c != key]
    picked = batch.groupBy(key).agg(F.min(F.struct(*ordered)).alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in cols])


def new_rows(batch: DataFrame, existing_keys: DataFrame, key: str = "order_id", order=ARRIVAL_ORDER) -> DataFrame:
    """Rows of `batch` whose key is not yet in the target: first arrival wins.

    The anti join comes first, so a re-load aggregates nothing and adaptive
    execution can split a hot key on the batch side. NULL keys cannot conflict
    and are not inserted (the gate rejects them).
    """
    unseen = batch.filter(F.col(key).isNotNull()).join(existing_keys.select(key), key, "left_anti").select(*batch.columns)
    return first_arrival(unseen, key, order)


#: Bits of a sieve per key of the batch, and the most and least bits of one (32 MB and 512 kB).
SIEVE_BITS_EACH = 16
SIEVE_MOST = 1 << 28
SIEVE_LEAST = 1 << 22
#: Values of the partition columns that a predicate on a target lists at most.
MOST_PARTITIONS = 10_000


def key_sieve(batch: DataFrame, key: str) -> tuple[DataFrame, int]:
    """(bucket, bits) rows of a bitmap over the hashes of the batch's keys, and its number of bits.

    Built by Spark from partial bitmaps; its size is bounded whatever the
    batch. The batch is read once if the least size does for it, else twice.
    """
    bits, seen = min(SIEVE_LEAST, SIEVE_MOST), Observation("key_sieve")
    least = _bitmap(batch.observe(seen, F.count(F.lit(1)).alias("rows")), key, bits)
    path = scratch_path(batch.sparkSession, "key_sieve")
    least.write.parquet(path)
    wanted = min(SIEVE_MOST, SIEVE_BITS_EACH * int(seen.get.get("rows", 0)))
    if wanted <= bits:
        return batch.sparkSession.read.schema(least.schema).parquet(path), bits
    while bits < wanted:
        bits *= 2
    return _bitmap(batch, key, bits), bits


def _bitmap(batch: DataFrame, key: str, bits: int) -> DataFrame:
    place = _place(key, bits)
    rows = batch.filter(F.col(key).isNotNull()).select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    return rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _place(key: str, bits: int):
    return F.xxhash64(key).bitwiseAND(bits - 1)


def sieved_keys(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The existing keys that may be in the batch (all that are, few others).

    The bitmap goes to the tasks that scan the keys, so that only what passes
    is shuffled for the anti join: what is shuffled follows the batch, not the target.
    """
    sieve, bits = key_sieve(batch, key)
    place = _place(key, bits)
    byte, bit = F.shiftright(F.bitmap_bit_position(place), 3), F.bitmap_bit_position(place).bitwiseAND(7)
    probe = existing.select(F.col(key), F.bitmap_bucket_number(place).alias("_bucket"), byte.cast("int").alias("_byte"), bit.cast("int").alias("_bit"))
    hit = probe.join(F.broadcast(sieve), F.col("_bucket") == F.col("bucket"))
    word = F.conv(F.hex(F.expr("substring(bits, _byte + 1, 1)")), 16, 10).cast("int")
    return hit.filter(F.getbit(word, F.col("_bit")) == 1).select(key)


def batch_partitions(batch: DataFrame, columns) -> object | None:
    """A predicate that lists the batch's values of the partition columns; None if there are too many to list."""
    values = batch.select(*columns).distinct().limit(MOST_PARTITIONS + 1).collect()
    if len(values) > MOST_PARTITIONS:
        return None
    out = F.lit(False)
    if len(columns) == 1:
        listed = [v[0] for v in values if v[0] is not None]
        out = F.col(columns[0]).isin(listed) if listed else out
        return out | F.col(columns[0]).isNull() if any(v[0] is None for v in values) else out
    for first in sorted({v[0] for v in values}, key=lambda x: (x is not None, x)):
        rest = [v[1:] for v in values if v[0] == first]
        inner = F.lit(False)
        for v in rest:
            here = F.lit(True)
            for c, x in zip(columns[1:], v, strict=True):
                here = here & F.col(c).eqNullSafe(F.lit(x))
            inner = inner | here
        out = out | (F.col(columns[0]).eqNullSafe(F.lit(first)) & inner)
    return out


def target_layout(spark: SparkSession, path: str) -> tuple | None:
    """Partition columns of the Parquet table at `path`; None if the path is missing.

    Taken from one of the table's own files; any other failure to read the
    target is the caller's error and is raised.
    """
    if not exists(spark, path):
        return None
    target = spark.read.parquet(path)
    one = target.select(F.col("_metadata.file_path")).first()
    if one is None:
        return ()
    names = []
    for part in reversed(one[0].split("/")[:-1]):
        m = re.fullmatch(r"([^=]+)=.*", part)
        if not m:
            break
        names.append(m[1])
    return tuple(reversed(names))


def insert_if_absent(spark: SparkSession, batch: DataFrame, target_path: str,
                     key: str = "order_id", order=ARRIVAL_ORDER, partition_by=None, drop=("row_index",),
                     key_in_one_partition: bool = False) -> int:
    """Append to the Parquet table at `target_path` the rows whose key is absent.

    Re-running the same batch inserts nothing. Only the key column of the
    target is read (column pruning), and only keys that pass a sieve of the
    batch's keys are shuffled; the batch's rows are only if some are new. The table owns its layout: an existing
    target keeps its partition columns, and a caller that names others is
    refused; `partition_by` counts for a new target. `drop` names columns
    that order the arrivals and are not stored. With `key_in_one_partition`
    the caller states that a key always comes with the same values of the
    target's partition columns (an order keeps its day); then only the
    batch's partitions are read. Returns the number of rows
    inserted. Single writer per target is assumed (no unique index to
    arbitrate).
    """
    layout = target_layout(spark, target_path)
    if layout is None:
        layout = tuple(partition_by or ())
        fresh = new_rows(batch, spark.createDataFrame([], batch.select(key).schema), key, order)
    else:
        if partition_by is not None and tuple(partition_by) != layout:
            raise ValueError(f"{target_path} is partitioned by {list(layout)}, not by {list(partition_by)}")
        target = spark.read.parquet(target_path)
        if key not in target.columns:
            raise ValueError(f"{target_path} has no column {key}")
        unseen = unseen_rows(target, batch, key, layout if key_in_one_partition else ())
        if unseen is None:
            return 0
        fresh = first_arrival(unseen, key, order)
    fresh = fresh.drop(*drop)
    observed = Observation("insert_if_absent")
    writer = fresh.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("append")
    if layout:
        writer = writer.partitionBy(*layout)
    writer.parquet(target_path)
    return int(observed.get.get("rows", 0))


def unseen_rows(target: DataFrame, batch: DataFrame, key: str, same_partition=()) -> DataFrame | None:
    """The batch's rows whose key is not in the target; None if it has none.

    The batch's keys are written to the work folder, so its own plan runs once
    for all lookups; its whole rows are read only if there are new keys, and
    joined with those only if there are known ones too.
    """
    spark = batch.sparkSession
    rows = batch.filter(F.col(key).isNotNull())

    def keep(df, name):
        path, seen = scratch_path(spark, name), Observation(name)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), int(seen.get.get("rows", 0))

    keys, n = keep(rows.select(key, *[c for c in same_partition if c != key]), "batch_keys")
    known = known_keys(target, keys, key, same_partition)
    new, n_new = keep(keys.select(key).join(known, key, "left_anti"), "new_keys")
    if not n_new:
        return None
    return rows if n_new == n else rows.join(new, key, "left_semi").select(*batch.columns)


def known_keys(target: DataFrame, batch: DataFrame, key: str, same_partition=()) -> DataFrame:
    """The target's keys that matter to the batch: of its partitions, if keys keep theirs, and through the sieve."""
    if same_partition:
        here = batch_partitions(batch, list(same_partition))
        target = target if here is None else target.filter(here)
    return sieved_keys(target.select(key), batch, key)


def insert_if_absent_table(spark: SparkSession, batch: DataFrame, table: str, key: str = "order_id",
                           order=ARRIVAL_ORDER, buckets: int | None = None, partition_by=None,
                           drop=("row_index",)) -> int:
    """K5 into a catalog table bucketed by the key (and optionally partitioned).

    The target is created bucketed (and sorted) by `key` on first load with
    `buckets` buckets. On later loads its key column is read bucket by bucket,
    so the anti join shuffles only the incoming batch to the target's buckets;
    the history is never shuffled again. Each load writes at most one file per
    bucket (times the partitions, if `partition_by` asks for any: every
    partition value multiplies the files, so partition coarsely or not at all).
    Returns the number of rows inserted.
    """
    observed = Observation("insert_if_absent_table")
    count = F.count(F.lit(1)).alias("rows")
    if not spark.catalog.tableExists(table):
        n = buckets or BUCKETS
        fresh = new_rows(batch, spark.createDataFrame([], batch.select(key).schema), key, order).drop(*drop)
        writer = fresh.observe(observed, count).repartition(n, key).write.format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.bucketBy(n, key).sortBy(key).saveAsTable(table)
        return int(observed.get.get("rows", 0))
    target = spark.table(table)
    fresh = new_rows(batch, target.select(key), key, order).drop(*drop)
    fresh = fresh.select(*target.columns)  # insertInto is positional
    n = _buckets_of(spark, table)
    if n:
        fresh = fresh.observe(observed, count).repartition(n, key)
    else:
        fresh = fresh.observe(observed, count)
    fresh.write.insertInto(table)
    return int(observed.get.get("rows", 0))


def _buckets_of(spark: SparkSession, table: str) -> int:
    """The buckets of a catalog table, 0 if it has none."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").select("data_type").collect()
    return int(rows[0][0]) if rows else 0
