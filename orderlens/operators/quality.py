"""Data-quality checks (Q1-Q17).

Each check returns a DataFrame: either the violating rows (pass <=> empty)
or a one-row report carrying `passed` and `n_failed`. `summarize` turns
either kind into a (check, passed, n_failed) row; `quality_summary` unions
them lazily and `run_checks` evaluates them one by one so that a check
that errors counts as failed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.config import CATEGORIES, CATEGORY_PRICE_RANGES, DEFAULT_RULE, FraudRule
from orderlens.operators import profile
from orderlens.operators.conform import to_staging_source
from orderlens.operators.staging import STAGING_NAMES, fits, staging_columns
from orderlens.schemas import RAW_ORDERS


#: Most ranges that a check takes as a parameter (they are broadcast).
MAX_RANGES = 10_000


def _report(df: DataFrame, passed, n_failed) -> DataFrame:
    return df.select("*", passed.alias("passed"), n_failed.cast("long").alias("n_failed"))


# --- warehouse verification (Q1-Q6) -------------------------------------------

def check_row_counts(raw: DataFrame) -> DataFrame:
    """Q1: the table is not empty."""
    counts = raw.agg(F.count(F.lit(1)).alias("row_count"))
    return _report(counts, F.col("row_count") > 0, F.when(F.col("row_count") > 0, 0).otherwise(1))


def check_nulls(raw: DataFrame) -> DataFrame:
    """Q2: no NULL order_id, customer_id, amount, order_timestamp."""
    nulls = profile.null_counts(raw)
    total = sum((F.col(c) for c in nulls.columns), F.lit(0))
    return _report(nulls, total == 0, total)


def check_duplicates(raw: DataFrame, key: str = "order_id") -> DataFrame:
    """Q3: violations = every duplicated key with its count."""
    return profile.duplicate_keys(raw, key)


def duplicate_sample(raw: DataFrame, n: int = 5, key: str = "order_id") -> DataFrame:
    """Q3 / T4 report: a sample of n duplicated keys (the check itself uses all)."""
    return profile.duplicate_keys(raw, key).limit(n)


def check_ranges(raw: DataFrame) -> DataFrame:
    """Q4: no negative amount; with the amount / time range."""
    rng = raw.agg(
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
        F.min("order_timestamp").alias("min_date"), F.max("order_timestamp").alias("max_date"),
        F.count_if(F.col("amount") < 0).alias("negative_count"))
    return _report(rng, F.col("negative_count") == 0, F.col("negative_count"))


def check_fraud_logic(raw: DataFrame, rule: FraudRule = DEFAULT_RULE,
                      amount: str = "amount", age: str = "customer_age_days") -> DataFrame:
    """Q5: flag agrees with the rule (strict form, both directions, one pass)."""
    a, d, f = F.col(amount), F.col(age), F.col("is_fraud")
    t, days = F.lit(float(rule.amount_threshold)), F.lit(int(rule.tenure_days))
    res = raw.agg(
        F.count_if((a > t) & (d < days) & (f == F.lit(False))).alias("false_negatives"),
        F.count_if(((a <= t) | (d >= days)) & (f == F.lit(True))).alias("false_positives"))
    n = F.col("false_negatives") + F.col("false_positives")
    return _report(res, n == 0, n)


def check_partitions(raw: DataFrame) -> DataFrame:
    """Q6: partition columns populated (distinct years, months, days > 0)."""
    parts = profile.partition_profile(raw)
    empty = sum((F.when(F.col(c) == 0, 1).otherwise(0) for c in ("years", "months", "days")), F.lit(0))
    return _report(parts, empty == 0, empty)


# --- model tests (Q7-Q12) -------------------------------------------------------

def test_unique(df: DataFrame, column: str) -> DataFrame:
    """Q7: non-NULL values occurring more than once."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def test_not_null(df: DataFrame, columns) -> DataFrame:
    """Q8: one violation row per (row, NULL column), tagged with the column name."""
    tags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    hit = F.filter(tags, lambda x: x.isNotNull())
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.filter(any_null).select(F.explode(hit).alias("column_name"), *df.columns)


def test_accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                        inclusive: bool = True) -> DataFrame:
    """Q9: rows outside [min, max] (NULL passes)."""
    c = F.col(column)
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & ((c >= F.lit(min_value)) if inclusive else (c > F.lit(min_value)))
    if max_value is not None:
        ok = ok & ((c <= F.lit(max_value)) if inclusive else (c < F.lit(max_value)))
    return df.filter(~ok)


def check_volume(df: DataFrame, min_rows: int = 100) -> DataFrame:
    """Q10: one row (the count) when the model has fewer than min_rows rows."""
    return profile.row_count_below(df, min_rows)


def test_fraud_accuracy(stg: DataFrame, rule: FraudRule = DEFAULT_RULE) -> DataFrame:
    """Q11: the model-test form; its false-positive branch uses AND (weaker than Q5)."""
    a, d, f = F.col("total_amount"), F.col("customer_age_days"), F.col("is_fraud")
    t, days = F.lit(float(rule.amount_threshold)), F.lit(int(rule.tenure_days))
    bad = ((a > t) & (d < days) & (f == F.lit(False))) | ((a <= t) & (d >= days) & (f == F.lit(True)))
    return stg.filter(bad).select("order_id", "total_amount", "customer_age_days", "is_fraud")


def test_freshness(df: DataFrame, as_of: dt.datetime, column: str = "processed_time",
                   max_age_hours: int = 1) -> DataFrame:
    """Q12: rows whose column is outside [as_of - max_age, as_of] (NULL passes)."""
    hi = F.to_timestamp(F.lit(as_of.isoformat(sep=" ")))
    lo = hi - F.make_dt_interval(F.lit(0), F.lit(int(max_age_hours)), F.lit(0), F.lit(0))
    c = F.col(column)
    return df.filter(~c.between(lo, hi))


# --- generator-side rules (Q14-Q16) ---------------------------------------------

def test_accepted_values(df: DataFrame, column: str, values=CATEGORIES) -> DataFrame:
    """Q14: rows whose value is not in the accepted list (NULL passes)."""
    return df.filter(~F.col(column).isin(list(values)))


def test_category_range(df: DataFrame, category: str = "product_category", amount: str = "amount",
                        ranges=None) -> DataFrame:
    """Q15: amount outside its category's [min, max], or a category without a range.

    The range table is the caller's parameter, at most MAX_RANGES rows, so it
    is broadcast; the orders are never shuffled.
    """
    ranges = dict(CATEGORY_PRICE_RANGES if ranges is None else ranges)
    if len(ranges) > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} ranges: pass them as a table and join it")
    spark = df.sparkSession
    schema = T.StructType([T.StructField("_cat", T.StringType()), T.StructField("_lo", T.DoubleType()),
                           T.StructField("_hi", T.DoubleType())])
    table = spark.createDataFrame([(k, float(lo), float(hi)) for k, (lo, hi) in ranges.items()], schema)
    joined = df.join(F.broadcast(table), F.col(category) == F.col("_cat"), "left")
    reason = (F.when(F.col("_cat").isNull(), F.lit("unknown_category"))
              .when(~F.col(amount).between(F.col("_lo"), F.col("_hi")), F.lit("out_of_range")))
    return joined.select(*df.columns, reason.alias("violation")).filter(F.col("violation").isNotNull())


def check_event_structure(df: DataFrame, required=None) -> DataFrame:
    """Q16: required fields present with their types; amount > 0 and tenure >= 1.

    Missing or mistyped fields make every row a violation; otherwise the
    violating rows are returned with a reason.
    """
    required = required or {"order_id": T.StringType(), "customer_id": T.StringType(),
                            "amount": T.DoubleType(), "timestamp": T.StringType(),
                            "product_category": T.StringType(), "customer_tenure_days": T.IntegerType()}
    types = {f.name: f.dataType for f in df.schema.fields}
    broken = [n for n, t in required.items() if types.get(n) != t]
    if broken:
        return df.select("*", F.lit("schema:" + ",".join(broken)).alias("violation"))
    reason = (F.when(F.col("amount").isNull() | (F.col("amount") <= 0), F.lit("amount_not_positive"))
              .when(F.col("customer_tenure_days").isNull() | (F.col("customer_tenure_days") < 1),
                    F.lit("tenure_below_one")))
    return df.select("*", reason.alias("violation")).filter(F.col("violation").isNotNull())


# --- summary (Q17) ----------------------------------------------------------------

SUMMARY_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("passed", T.BooleanType(), True),
    T.StructField("n_failed", T.LongType(), True),
    T.StructField("error", T.StringType(), True),
])


def summarize(name: str, result: DataFrame) -> DataFrame:
    """(check, passed, n_failed, error) for a report or a violation DataFrame."""
    if "passed" in result.columns and "n_failed" in result.columns:
        return result.select(F.lit(name).alias("check"), "passed", "n_failed",
                             F.lit(None).cast("string").alias("error"))
    n = result.agg(F.count(F.lit(1)).alias("n_failed"))
    return n.select(F.lit(name).alias("check"), (F.col("n_failed") == 0).alias("passed"), "n_failed",
                    F.lit(None).cast("string").alias("error"))


def quality_summary(spark: SparkSession, checks: dict) -> DataFrame:
    """Q17 (lazy): one row per check; a check that cannot even be planned
    (missing column, bad type) is reported failed with its error."""
    parts = []
    for name, build in checks.items():
        try:
            parts.append(summarize(name, build()))
        except Exception as e:  # analysis errors surface at build time
            parts.append(spark.createDataFrame([(name, False, None, type(e).__name__)], SUMMARY_SCHEMA))
    if not parts:
        return spark.createDataFrame([], SUMMARY_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(spark: SparkSession, checks: dict) -> DataFrame:
    """Q17 (eager): evaluate each check on its own; an error counts as failed.

    Only the one-row summaries come back to the driver.
    """
    rows = []
    for name, build in checks.items():
        try:
            r = summarize(name, build()).first()
            rows.append((name, bool(r["passed"]), int(r["n_failed"]), None))
        except Exception as e:
            rows.append((name, False, None, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def failing_rows(raw: DataFrame, rule: FraudRule = DEFAULT_RULE) -> dict:
    """The rows behind the warehouse suite's failures, by check (checks of a mere count have none)."""
    a, d, f = F.col("amount"), F.col("customer_age_days"), F.col("is_fraud")
    t, days = F.lit(float(rule.amount_threshold)), F.lit(int(rule.tenure_days))
    nulls = [F.col(c).isNull() for c in ("order_id", "customer_id", "amount", "order_timestamp")]
    return {
        "check_nulls": lambda: raw.filter(nulls[0] | nulls[1] | nulls[2] | nulls[3]),
        "check_duplicates": lambda: check_duplicates(raw),
        "check_ranges": lambda: raw.filter(a < 0),
        "check_fraud_logic": lambda: raw.filter(((a > t) & (d < days) & ~f) | (((a <= t) | (d >= days)) & f)),
    }


_STAGED = {"order_id", "customer_id", "product_id", "quantity", "price", "amount", "order_timestamp",
           "customer_age_days", "is_fraud", "loaded_at"}
#: Columns of raw.orders that each check of the warehouse suite reads (staging reads its ten source columns).
READS = {
    "check_row_counts": set(),
    "check_nulls": {"order_id", "customer_id", "amount", "order_timestamp"},
    "check_duplicates": {"order_id"},
    "check_ranges": {"amount"},
    "check_fraud_logic": {"amount", "customer_age_days", "is_fraud"},
    "check_partitions": {"year", "month", "day"},
    "test_unique_order_id": _STAGED,
    "test_not_null_order_id": _STAGED,
    "test_accepted_range_total_amount": _STAGED,
    "test_fraud_accuracy": _STAGED,
    "check_volume": _STAGED,
}


def warehouse_summary(raw: DataFrame, rule: FraudRule = DEFAULT_RULE, min_rows: int = 100,
                      amount_range=(0, 10000), stg_not_null=("order_id", "total_amount", "order_date")) -> DataFrame:
    """Q17 for the warehouse suite over raw.orders and its staging model, fused.

    Staging rows are a projection of raw rows, so grouping raw rows by the
    13 staging columns *is* the staging de-duplication; the raw-level counts
    (NULLs, negatives, fraud logic, partition columns) ride along as sums.
    A second grouping by order_id yields duplicate keys (raw) and non-unique
    keys (staging); a last one-row aggregate gives the totals. So the whole
    suite reads raw once with two keyed aggregations, both combined
    map-side (a hot key costs one row per task). The verdicts equal those of
    the individual checks. A check whose columns are missing or mistyped
    counts as failed, with its error, and the others go on.
    """
    types = {f.name: f.dataType for f in RAW_ORDERS.fields}
    wrong = {c for c in types if c not in raw.columns or raw.schema[c].dataType != types[c]}
    if wrong:  # stand-ins; the checks that read them are reported as errors
        raw = raw.drop(*wrong).select("*", *[F.lit(None).cast(types[c]).alias(c) for c in sorted(wrong)])
    t, days = F.lit(float(rule.amount_threshold)), F.lit(int(rule.tenure_days))
    a, d, f = F.col("amount"), F.col("customer_age_days"), F.col("is_fraud")

    def flag(cond):
        return F.when(cond, 1).otherwise(0)

    raw_flags = [
        flag(F.col("customer_id").isNull()).alias("_nc"),
        flag(a.isNull()).alias("_na"),
        flag(F.col("order_timestamp").isNull()).alias("_nt"),
        flag(a < 0).alias("_neg"),
        flag((a > t) & (d < days) & (f == F.lit(False))).alias("_fn"),
        flag(((a <= t) | (d >= days)) & (f == F.lit(True))).alias("_fp"),
        flag(F.col("year").isNotNull()).alias("_y"),
        flag(F.col("month").isNotNull()).alias("_m"),
        flag(F.col("day").isNotNull()).alias("_d"),
    ]
    flags = ("_nc", "_na", "_nt", "_neg", "_fn", "_fp", "_y", "_m", "_d")
    rows = to_staging_source(raw.select("*", *raw_flags)).select(*staging_columns(), fits().alias("_fit"), *flags)
    # 1) one group per distinct staging row, carrying its raw rows' counts
    staged = rows.groupBy(*STAGING_NAMES, "_fit").agg(F.count(F.lit(1)).alias("_rows"),
                                               *[F.sum(c).alias(c) for c in flags])
    amt = F.col("total_amount")
    lo, hi = amount_range
    in_stg = F.col("order_timestamp").isNotNull() & F.col("_fit")
    stg_nulls = sum((flag(F.col(c).isNull()) for c in stg_not_null), F.lit(0))
    # 2) per order id: raw duplicates and staging uniqueness, plus the row-level counts
    per_key = staged.groupBy("order_id").agg(
        F.sum("_rows").alias("n_raw"),
        F.count_if(in_stg).alias("n_stg"),
        *[F.sum(c).alias(c) for c in flags],
        F.sum(F.when(in_stg, stg_nulls).otherwise(0)).alias("_nn"),
        F.count_if(in_stg & ~((amt >= F.lit(lo)) & (amt <= F.lit(hi)))).alias("_rng"),
        F.count_if(in_stg & (((amt > t) & (d < days) & (f == F.lit(False)))
                             | ((amt <= t) & (d >= days) & (f == F.lit(True))))).alias("_acc"),
    )

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    # 3) totals
    r = per_key.agg(
        total("n_raw").alias("rows"),
        total(F.when(F.col("order_id").isNull(), F.col("n_raw")).otherwise(0)).alias("no"),
        *[total(c).alias(c) for c in flags],
        F.count_if(F.col("n_raw") > 1).alias("dups"),
        F.count_if(F.col("order_id").isNotNull() & (F.col("n_stg") > 1)).alias("uniq"),
        total("_nn").alias("_nn"), total("_rng").alias("_rng"), total("_acc").alias("_acc"),
        total("n_stg").alias("stg_rows"),
    )
    nulls = F.col("no") + F.col("_nc") + F.col("_na") + F.col("_nt")
    empty_parts = sum((F.when(F.col(c) == 0, 1).otherwise(0) for c in ("_y", "_m", "_d")), F.lit(0))
    items = [
        ("check_row_counts", F.when(F.col("rows") > 0, 0).otherwise(1)),
        ("check_nulls", nulls),
        ("check_duplicates", F.col("dups")),
        ("check_ranges", F.col("_neg")),
        ("check_fraud_logic", F.col("_fn") + F.col("_fp")),
        ("check_partitions", empty_parts),
        ("test_unique_order_id", F.col("uniq")),
        ("test_not_null_order_id", F.col("_nn")),
        ("test_accepted_range_total_amount", F.col("_rng")),
        ("test_fraud_accuracy", F.col("_acc")),
        ("check_volume", F.when(F.col("stg_rows") < min_rows, 1).otherwise(0)),
    ]
    entries = []
    for name, n in items:
        lost = sorted(wrong & READS[name])
        error = f"missing or mistyped columns: {', '.join(lost)}" if lost else None
        failed = F.lit(None).cast("long") if lost else n.cast("long")
        entries.append(F.struct(F.lit(name).alias("check"), failed.alias("n_failed"), F.lit(error).cast("string").alias("error")))
    return r.select(F.inline(F.array(*entries))).select(
        "check", F.coalesce(F.col("n_failed") == 0, F.lit(False)).alias("passed"), "n_failed", "error")
