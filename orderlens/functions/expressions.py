"""Scalar and aggregate building blocks.

Rounding follows SQL NUMERIC rules (half away from zero on exact values):
ratios are formed on decimals, never on doubles, so `round(x, 2)` cannot
double-round. Money sums are exact decimals, which also makes them
independent of how rows are partitioned; doubles appear only at the edge.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.config import FraudRule


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fraud_flag(rule: FraudRule, amount="amount", tenure="customer_tenure_days") -> Column:
    """True iff amount > threshold and tenure < days; NULL inputs give False."""
    hit = (_c(amount) > F.lit(float(rule.amount_threshold))) & (_c(tenure) < F.lit(int(rule.tenure_days)))
    return F.when(hit, F.lit(True)).otherwise(F.lit(False))


def fraud_reason(rule: FraudRule, flag="is_fraud") -> Column:
    return F.when(_c(flag), F.lit(rule.reason)).otherwise(F.lit(None).cast("string"))


def date_parts(ts="event_time") -> list[Column]:
    """year / month / day partition columns of an event time (session zone)."""
    t = _c(ts)
    return [F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day")]


def pg_day_of_week(ts) -> Column:
    """Day of week with 0 = Sunday (Spark's dayofweek is 1 = Sunday)."""
    return (F.dayofweek(_c(ts)) - F.lit(1)).cast("int")


def customer_segment(age) -> Column:
    """<30 new, 30..90 active, >90 loyal, NULL stays NULL."""
    a = _c(age)
    return (
        F.when(a < 30, F.lit("new"))
        .when(a.between(30, 90), F.lit("active"))
        .when(a > 90, F.lit("loyal"))
    )


def risk_category(rate) -> Column:
    """Band on the already rounded rate: >10 high, 5..10 medium, else low."""
    r = _c(rate)
    return (
        F.when(r > 10, F.lit("high_risk"))
        .when(r.between(5, 10), F.lit("medium_risk"))
        .otherwise(F.lit("low_risk"))
    )


def time_of_day(hour) -> Column:
    h = _c(hour)
    return (
        F.when(h.between(0, 6), F.lit("night"))
        .when(h.between(7, 12), F.lit("morning"))
        .when(h.between(13, 18), F.lit("afternoon"))
        .otherwise(F.lit("evening"))
    )


def round_ratio(num, den, scale: int = 2) -> Column:
    """round(num / nullif(den, 0), scale) on decimals (exact, half away from zero).

    Inputs are decimals or integers; decimal(20, s) keeps >= 15 digits of
    scale in the quotient, so the final rounding sees the exact value.
    """
    n = _c(num)
    d = _c(den)
    return F.round(n / F.nullif(d, F.lit(0)), scale)


def rate_pct(part, whole, scale: int = 2) -> Column:
    """round(part / nullif(whole, 0) * 100, scale) for counts, exactly."""
    p = _c(part).cast("decimal(20,0)") * F.lit(100)
    return round_ratio(p, _c(whole).cast("decimal(20,0)"), scale)


def exact_money(amount) -> Column:
    """A double money column as an exact decimal; NULL if it is not finite or too large."""
    return _c(amount).try_cast("decimal(38,10)")


def exact_money_sum(amount) -> Column:
    """Sum of a double money column, exact to 10 decimal places (see `exact_money`)."""
    return F.sum(exact_money(amount))


def to_double(col) -> Column:
    return _c(col).cast("double")
