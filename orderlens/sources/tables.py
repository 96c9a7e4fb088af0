"""Reading the given Parquet tables and declared catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def declared_source(spark: SparkSession, name: str = "raw.orders") -> DataFrame:
    """A declared source table of the catalog (e.g. raw.orders)."""
    return spark.table(name)
