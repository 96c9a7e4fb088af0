"""Column expressions shared by the operators (all JVM-side built-ins)."""

from orderlens.functions.expressions import (  # noqa: F401
    customer_segment,
    date_parts,
    exact_money,
    exact_money_sum,
    fraud_flag,
    fraud_reason,
    pg_day_of_week,
    rate_pct,
    risk_category,
    round_ratio,
    time_of_day,
    to_double,
)
