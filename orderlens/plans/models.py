"""The model DAG (S8): staging -> intermediate -> marts.

Each model is a function of its upstream DataFrames. `build_models` runs
them in dependency order; a model read by several others is written once
as a Parquet table in the shared work folder and read back, so the marts
do not each recompute staging (and lineage is cut there). Views (K8) are
registered as temp views; tables (K7) are written with a swap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators import marts, staging
from orderlens.session import scratch_path
from orderlens.sinks import writers


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple
    build: Callable[..., DataFrame]
    materialized: str  # "view", "table", "rollup" (refreshed in place) or "declared" (a declared table, refilled)
    layer: str


#: A customer is of high value above this lifetime value (parameter of the declared customer table).
HIGH_VALUE = 1_000_000.0


def _customer_metrics(stg: DataFrame) -> DataFrame:
    return marts.customer_metrics_contract(stg, HIGH_VALUE)


MODELS = (
    Model("stg_orders", ("raw_orders",), staging.stg_orders, "view", "staging"),
    Model("stg_customers", ("stg_orders",), staging.stg_customers, "view", "staging"),
    Model("int_customer_360", ("stg_orders",), marts.customer_360, "view", "intermediate"),
    Model("mart_daily_revenue", ("stg_orders",), marts.daily_revenue, "table", "marts"),
    Model("mart_fraud_analysis", ("stg_orders", "stg_customers"), marts.fraud_analysis, "table", "marts"),
    Model("hourly_metrics", ("raw_orders",), marts.hourly_metrics, "rollup", "analytics"),
    Model("daily_revenue", ("stg_orders",), marts.daily_revenue_contract, "declared", "analytics"),
    Model("customer_metrics", ("stg_orders",), _customer_metrics, "declared", "analytics"),
)


def topological(models=MODELS, sources=("raw_orders",)) -> list:
    done, order, pending = set(sources), [], list(models)
    while pending:
        ready = [m for m in pending if all(i in done for i in m.inputs)]
        if not ready:
            raise ValueError(f"cycle or missing input among {[m.name for m in pending]}")
        for m in ready:
            order.append(m)
            done.add(m.name)
            pending.remove(m)
    return order


def build_models(spark: SparkSession, raw_orders: DataFrame, models=MODELS, write_tables: bool = False,
                 reuse_shared: bool = True) -> dict:
    """Build every model; returns name -> DataFrame.

    write_tables: also save `table` models as catalog tables `<layer>.<name>`
    (and register `view` models as temp views).
    """
    frames = {"raw_orders": raw_orders}
    consumers = {}
    for m in models:
        for i in m.inputs:
            consumers[i] = consumers.get(i, 0) + 1
    for m in topological(models):
        df = m.build(*[frames[i] for i in m.inputs])
        if reuse_shared and consumers.get(m.name, 0) > 1:
            path = scratch_path(spark, f"model_{m.name}")
            df.write.parquet(path)
            df = spark.read.parquet(path)
        if write_tables:
            if m.materialized == "declared":
                writers.create_warehouse_tables(spark)
                writers.load_declared(df, f"{m.layer}.{m.name}")
                df = spark.table(f"{m.layer}.{m.name}")
            elif m.materialized in ("table", "rollup"):
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {m.layer}")
                if m.materialized == "table":
                    writers.materialize_table(spark, df, f"{m.layer}.{m.name}")
                else:
                    writers.refresh_rollup(spark, df, f"{m.layer}.{m.name}")
                df = spark.table(f"{m.layer}.{m.name}")
            else:
                writers.materialize_view(df, m.name)
        frames[m.name] = df
    return frames
