"""Column conformance between the stream, warehouse and staging shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import date_parts
from orderlens.schemas import LOAD_COLUMNS, RAW_ORDERS, STREAM_TO_WAREHOUSE, WAREHOUSE_TO_STAGING


def with_partition_columns(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Year / month / day of the event time, for a Hive-style layout."""
    return df.select("*", *date_parts(ts))


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add every column of `schema` that `df` lacks as a typed NULL."""
    present = set(df.columns)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in present]
    return df.select("*", *missing) if missing else df


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


#: Names the values of a row that don't fit their declared column, NULL if all do.
UNFIT = "_unfit"


def to_warehouse(flagged: DataFrame, columns=LOAD_COLUMNS, keep=(), unfit: bool = False) -> DataFrame:
    """Stream-shaped flagged orders -> the 16 load columns of raw.orders (P10 order).

    Renames the stream names, derives the partition columns if absent,
    pads absent columns with NULL, casts to the declared types and selects
    in load order. A value that does not fit (an amount of 1e11, NaN) never
    ends the job: it becomes NULL, and with `unfit` the row carries the
    column's name in `UNFIT`, which the constraint gate turns into a
    violation. `keep` names columns passed through behind the declared ones.
    """
    df = flagged
    if "year" not in df.columns and "event_time" in df.columns:
        df = with_partition_columns(df, "event_time")
    df = rename(df, STREAM_TO_WAREHOUSE)
    df = add_missing_columns(df, RAW_ORDERS)
    types = {f.name: f.dataType for f in RAW_ORDERS.fields}
    out = [F.col(c).try_cast(types[c]).alias(c) for c in columns]
    out += [F.col(c) for c in keep]
    if unfit:
        lost = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull(), F.lit(f"{c}_unfit")) for c in columns]
        names = F.concat_ws(",", *lost)
        out.append(F.when(names != "", names).alias(UNFIT))
    return df.select(*out)


def to_staging_source(raw: DataFrame) -> DataFrame:
    """Raw.orders names -> staging source names (amount -> total_amount, ...)."""
    return rename(raw, WAREHOUSE_TO_STAGING)
