"""The view models as SQL text (K8), beside their DataFrame form in `operators`.

Stored with `CREATE OR REPLACE VIEW`, a model outlives the session and every
reader recomputes it from the tables it names. `tests/test_views.py` and the
query `model_views` hold the text against the DataFrame form. The customer
360 is written with its join here, as the model is declared; its DataFrame form
folds the join into the aggregation.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from orderlens.schemas import STG_ORDERS, WAREHOUSE_TO_STAGING
from orderlens.sinks.writers import create_view

_SOURCE = {new: old for old, new in WAREHOUSE_TO_STAGING.items()}


def stg_orders(raw: str) -> str:
    cast = {name: f"try_cast({_SOURCE.get(name, name)} AS {kind})" for name, kind in STG_ORDERS}
    fits = [f"({_SOURCE.get(n, n)} IS NULL OR {cast[n]} IS NOT NULL)" for n, kind in STG_ORDERS if kind.startswith(("decimal", "int"))]
    columns = ",\n       ".join(f"{c} AS {n}" for n, c in cast.items())
    return f"""SELECT DISTINCT {columns},
       to_date(order_timestamp) AS order_date,
       hour(order_timestamp) AS order_hour,
       dayofweek(order_timestamp) - 1 AS order_day_of_week
FROM {raw} WHERE order_timestamp IS NOT NULL AND {' AND '.join(fits)}"""


def stg_customers(stg: str) -> str:
    return f"""SELECT customer_id, first_order_date, last_order_date, total_orders, round(spent, 2) AS lifetime_value,
       round(spent / nullif(amounts, 0), 2) AS avg_order_value, current_age_days,
       CASE WHEN current_age_days < 30 THEN 'new' WHEN current_age_days <= 90 THEN 'active'
            WHEN current_age_days > 90 THEN 'loyal' END AS customer_segment
FROM (SELECT customer_id, min(order_timestamp) AS first_order_date, max(order_timestamp) AS last_order_date,
             count(DISTINCT order_id) AS total_orders, sum(total_amount) AS spent, count(total_amount) AS amounts,
             max(customer_age_days) AS current_age_days
      FROM {stg} GROUP BY customer_id)"""


def customer_360(stg: str, customers: str) -> str:
    return f"""SELECT *, CASE WHEN fraud_rate_pct > 10 THEN 'high_risk' WHEN fraud_rate_pct >= 5 THEN 'medium_risk' ELSE 'low_risk' END AS risk_category
FROM (SELECT o.customer_id, c.customer_segment, c.lifetime_value, c.total_orders, count_if(o.is_fraud) AS fraud_orders,
             round(CAST(count_if(o.is_fraud) AS DECIMAL(20, 0)) * 100 / nullif(CAST(count(1) AS DECIMAL(20, 0)), 0), 2) AS fraud_rate_pct
      FROM {stg} o LEFT JOIN {customers} c ON o.customer_id = c.customer_id
      GROUP BY o.customer_id, c.customer_segment, c.lifetime_value, c.total_orders)"""


def create_views(spark: SparkSession, raw: str, staging: str = "staging", intermediate: str = "intermediate") -> dict[str, str]:
    """Store the view models over a catalog table of raw.orders; model -> view name."""
    for layer in (staging, intermediate):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    orders = create_view(spark, f"{staging}.stg_orders_view", stg_orders(raw))
    customers = create_view(spark, f"{staging}.stg_customers_view", stg_customers(orders))
    return {"stg_orders": orders, "stg_customers": customers,
            "int_customer_360": create_view(spark, f"{intermediate}.int_customer_360_view", customer_360(orders, customers))}
