"""Sharding: a two-pass external shuffle into shards of equal row counts.

DataFrame functions only. Pass one scatters the records uniformly into
memory-sized buckets by a seeded hash of their place in the input (never of
their content, so copies and hot keys spread like any other rows) and writes
them to the shared work folder. Pass two brings each bucket together, gives it
a Fisher-Yates shuffle (Spark's ``shuffle``, seeded) and lays the buckets end
to end: row g of N goes to shard ``g * shards div N``, which holds the counts
of the shards at most one apart.

The number of buckets follows the bytes of the input, so a bucket has about
``bucket_bytes`` at any size; only bucket counts (one row per bucket) are
summed in one place.

Defined cases: null texts count no bytes; null ids, repeated rows and ties are
plain rows, each with its own slot; one very long text makes its bucket longer
by itself; fewer rows than shards leave shards empty; an empty table gives an
empty result; extra columns pass through, and the two result columns must not
clash with them (ValueError).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import free_name, written

#: Uncompressed bytes that a bucket holds on average.
BUCKET_BYTES = 8 << 20


def text_bytes(text_col: str = "text"):
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")


def shuffled_shards(
    docs: DataFrame,
    shards: int,
    seed: int = 42,
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    shard_col: str = "shard",
    slot_col: str = "slot",
) -> DataFrame:
    """The documents with a shard (int, from 0) and a slot in it (long, gapless from 0)."""
    if {shard_col.lower(), slot_col.lower()} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column named {shard_col} or {slot_col}")
    bucket, rid, pos, rec, at = (free_name(docs.columns, x) for x in ("_bucket", "_rid", "_pos", "_rec", "_start"))

    # 64 bytes stand for the other columns and the record's own overhead
    total = docs.agg(F.coalesce(F.sum(text_bytes(text_col) + 64), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total / bucket_bytes))
    scattered = written(
        docs.withColumn(rid, F.monotonically_increasing_id())
        .withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(rid)), F.lit(buckets))),
        "scattered",
    )

    sizes = scattered.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    start = sizes.select(
        bucket,
        F.coalesce(F.sum("n").over(Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(at),
        F.sum("n").over(Window.partitionBy()).alias("n"),
    )
    # one bucket is what one task can hold; the id first makes the order before the shuffle fixed
    together = scattered.repartition(buckets, bucket).groupBy(bucket).agg(
        F.sort_array(F.collect_list(F.struct(rid, *docs.columns))).alias(rec))
    placed = together.select(bucket, F.posexplode(F.shuffle(rec, F.lit(seed))).alias(pos, rec)).join(start, bucket)
    g = F.col(at) + F.col(pos)
    return (
        placed.withColumn(at, g)
        .withColumn(shard_col, F.expr(f"cast(({at} * {shards}) div n as int)"))
        .select(
            *[F.col(rec)[c].alias(c) for c in docs.columns], shard_col,
            # the first row of shard s is the least g with g * shards >= s * N
            (F.col(at) - F.expr(f"(cast({shard_col} as long) * n + {shards - 1}) div {shards}")).alias(slot_col),
        )
    )


def write_shards(sharded: DataFrame, path: str, shard_col: str = "shard", slot_col: str = "slot",
                 rows_per_file: int = 1_000_000) -> None:
    """One folder per shard, its files in slot order, at most ``rows_per_file`` rows each."""
    part = free_name(sharded.columns, "_part")
    (sharded.withColumn(part, F.expr(f"{slot_col} div {rows_per_file}"))
     .repartition(shard_col, part).sortWithinPartitions(shard_col, slot_col)
     .drop(part).write.option("maxRecordsPerFile", rows_per_file).partitionBy(shard_col).parquet(path))
