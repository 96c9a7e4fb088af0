"""ANSI SQL twins of the registered queries, for DuckDB over the same tables.

Rounded ratios are computed in exact integer arithmetic (half away from
zero), the NUMERIC semantics the Spark side gets from decimal `round`;
decimals leave as doubles, as at the Spark output edge.
"""

from __future__ import annotations

from orderlens.config import CATEGORIES, CATEGORY_PRICE_RANGES
from orderlens.sources.fixtures import F1_RULE, F2_LOADED_AT, F2_RULE


def half_up(num: str, den: str) -> str:
    """round(num / den) to an integer, half away from zero (hugeint math)."""
    n = f"CAST({num} AS HUGEINT)"
    d = f"CAST({den} AS HUGEINT)"
    return f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // NULLIF(2 * abs({d}), 0)))"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


def money_avg_2(sum_expr: str, count_expr: str) -> str:
    """round(sum / count, 2) as DOUBLE, for a scale-2 decimal sum."""
    return f"(CAST({half_up(cents(sum_expr), count_expr)} AS DOUBLE) / 100)"


def pct_2(part: str, whole: str) -> str:
    """round(part / whole * 100, 2) as DOUBLE."""
    return f"(CAST({half_up(f'({part}) * 10000', whole)} AS DOUBLE) / 100)"


def segment(age: str) -> str:
    return (f"CASE WHEN {age} < 30 THEN 'new' WHEN {age} BETWEEN 30 AND 90 THEN 'active' "
            f"WHEN {age} > 90 THEN 'loyal' END")


def _reason(rule) -> str:
    return rule.reason.replace("'", "''")


F2_BASE = """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
       CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(l_partkey AS VARCHAR) AS product_id,
       p_name AS product_name,
       p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS amount,
       o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS order_timestamp,
       CAST(o_custkey % 120 AS INTEGER) AS customer_age_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

_F2_HIT = f"(amount > {F2_RULE.amount_threshold} AND customer_age_days < {F2_RULE.tenure_days})"

RAW_CTE = f"""
raw AS (
  SELECT order_id, customer_id, product_id, product_name, category, price, quantity, amount,
         order_timestamp, customer_age_days,
         coalesce({_F2_HIT}, false) AS is_fraud,
         CASE WHEN {_F2_HIT} THEN '{_reason(F2_RULE)}' END AS fraud_reason,
         CAST(year(order_timestamp) AS INTEGER) AS year,
         CAST(month(order_timestamp) AS INTEGER) AS month,
         CAST(day(order_timestamp) AS INTEGER) AS day,
         TIMESTAMP '{F2_LOADED_AT}' AS loaded_at,
         CAST(NULL AS VARCHAR) AS source_file
  FROM ({F2_BASE}) f2
)"""

STG_CTE = RAW_CTE + """,
stg AS (
  SELECT DISTINCT order_id, customer_id, product_id, quantity, price,
         CAST(amount AS DECIMAL(10,2)) AS total_amount, order_timestamp, customer_age_days,
         is_fraud, loaded_at AS processed_time,
         CAST(order_timestamp AS DATE) AS order_date,
         CAST(hour(order_timestamp) AS INTEGER) AS order_hour,
         CAST(dayofweek(order_timestamp) AS INTEGER) AS order_day_of_week
  FROM raw WHERE order_timestamp IS NOT NULL
)"""

SQL: dict[str, str] = {}

SQL["stg_orders"] = f"""WITH {STG_CTE}
SELECT order_id, customer_id, product_id, quantity, CAST(price AS DOUBLE) AS price,
       CAST(total_amount AS DOUBLE) AS total_amount, order_timestamp, customer_age_days, is_fraud,
       processed_time, order_date, order_hour, order_day_of_week
FROM stg"""

SQL["stg_customers"] = f"""WITH {STG_CTE}
SELECT customer_id, min(order_timestamp) AS first_order_date, max(order_timestamp) AS last_order_date,
       count(DISTINCT order_id) AS total_orders,
       CAST(sum(total_amount) AS DOUBLE) AS lifetime_value,
       {money_avg_2('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
       max(customer_age_days) AS current_age_days,
       {segment('max(customer_age_days)')} AS customer_segment
FROM stg GROUP BY customer_id"""

# Fixed values below: output column names, segment and risk labels, CASE limits.
SQL["customer_360"] = f"""WITH {STG_CTE},
per_customer AS (
  SELECT customer_id, max(customer_age_days) AS age, sum(total_amount) AS spent,
         count(DISTINCT order_id) AS total_orders, count_if(is_fraud) AS fraud_orders, count(*) AS all_rows
  FROM stg GROUP BY customer_id
),
rated AS (
  SELECT *, customer_id IS NOT NULL AS known, {half_up('fraud_orders * 10000', 'all_rows')} AS rate FROM per_customer
)
SELECT customer_id, CASE WHEN known THEN {segment('age')} END AS customer_segment,
       CASE WHEN known THEN CAST(spent AS DOUBLE) END AS lifetime_value,
       CASE WHEN known THEN total_orders END AS total_orders,
       fraud_orders, CAST(rate AS DOUBLE) / 100 AS fraud_rate_pct,
       CASE WHEN rate > 1000 THEN 'high_risk' WHEN rate >= 500 THEN 'medium_risk' ELSE 'low_risk' END AS risk_category
FROM rated"""

_FRAUD_SUM = "sum(CASE WHEN is_fraud THEN total_amount ELSE 0 END)"

SQL["daily_revenue"] = f"""WITH {STG_CTE}
SELECT order_date, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(total_amount) AS DOUBLE) / NULLIF(count(total_amount), 0) AS avg_order_value,
       CAST({_FRAUD_SUM} AS DOUBLE) AS fraud_revenue,
       count(CASE WHEN is_fraud THEN 1 END) AS fraud_orders,
       (CAST({half_up(f'{cents(_FRAUD_SUM)} * 10000', cents('sum(total_amount)'))} AS DOUBLE) / 100) AS fraud_revenue_pct
FROM stg GROUP BY order_date ORDER BY order_date DESC"""

SQL["daily_revenue_contract"] = f"""WITH {STG_CTE}
SELECT order_date AS date, CAST(count(DISTINCT order_id) AS INTEGER) AS total_orders,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       {money_avg_2('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
       CAST(count(CASE WHEN is_fraud THEN 1 END) AS INTEGER) AS fraud_orders,
       CAST({_FRAUD_SUM} AS DOUBLE) AS fraud_amount
FROM stg GROUP BY order_date"""

SQL["fraud_analysis"] = f"""WITH {STG_CTE},
segment_of AS MATERIALIZED (
  SELECT customer_id AS who, {segment('max(customer_age_days)')} AS label FROM stg WHERE customer_id IS NOT NULL GROUP BY 1
),
bad AS (
  SELECT customer_id AS who, order_date AS d, order_hour AS h, count(*) AS k, sum(total_amount) AS s,
         count(total_amount) AS n, min(customer_age_days) AS lo, max(customer_age_days) AS hi
  FROM stg WHERE is_fraud GROUP BY ALL
)
SELECT d AS order_date, h AS order_hour, label AS customer_segment, CAST(sum(k) AS BIGINT) AS fraud_count,
       {money_avg_2('sum(s)', 'sum(n)')} AS avg_fraud_amount, min(lo) AS min_customer_age, max(hi) AS max_customer_age,
       CASE WHEN h <= 6 THEN 'night' WHEN h <= 12 THEN 'morning' WHEN h <= 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day
FROM bad LEFT JOIN segment_of USING (who) GROUP BY d, h, label
ORDER BY fraud_count DESC, order_date, order_hour, customer_segment"""

SQL["hourly_metrics"] = f"""WITH {RAW_CTE}
SELECT date_trunc('hour', order_timestamp) AS hour, count(*) AS order_count,
       CAST(sum(amount) AS DOUBLE) AS total_revenue,
       CAST(sum(amount) AS DOUBLE) / NULLIF(count(amount), 0) AS avg_order_value,
       count(*) FILTER (WHERE is_fraud = TRUE) AS fraud_count,
       CAST(sum(amount) FILTER (WHERE is_fraud = TRUE) AS DOUBLE) AS fraud_amount
FROM raw GROUP BY date_trunc('hour', order_timestamp)"""

SQL["customer_metrics_contract"] = f"""WITH {STG_CTE}
SELECT customer_id, CAST(min(order_timestamp) AS DATE) AS first_order_date,
       CAST(max(order_timestamp) AS DATE) AS last_order_date,
       CAST(count(DISTINCT order_id) AS INTEGER) AS total_orders,
       CAST(sum(total_amount) AS DOUBLE) AS total_spent,
       {money_avg_2('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
       sum(total_amount) > 1000000 AS is_high_value,
       CAST(count(CASE WHEN is_fraud THEN 1 END) AS INTEGER) AS fraud_orders
FROM stg WHERE customer_id IS NOT NULL GROUP BY customer_id"""


# --- stream-shaped orders (F1) --------------------------------------------------

_F1_HIT = f"(amount > {F1_RULE.amount_threshold} AND customer_tenure_days < {F1_RULE.tenure_days})"

F1_CTE = f"""
f1 AS (
  SELECT 'ord-' || CAST(event_id AS VARCHAR) AS order_id,
         'cust-' || CAST(user_id AS VARCHAR) AS customer_id,
         CAST(value AS DOUBLE) AS amount, 'USD' AS currency, event_type AS product_category,
         CAST(json_extract(props, '$.k') AS INTEGER) AS customer_tenure_days,
         CAST(NULL AS VARCHAR) AS customer_email, CAST(NULL AS VARCHAR) AS customer_country,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", 'order_created' AS event_type,
         ts AS kafka_timestamp, ts AS event_time
  FROM events
),
clean AS (
  SELECT * FROM f1
  WHERE amount > 0 AND isfinite(amount) AND customer_tenure_days >= 0 AND event_time IS NOT NULL
    AND order_id IS NOT NULL AND customer_id IS NOT NULL
),
flagged AS (
  SELECT *, coalesce({_F1_HIT}, false) AS is_fraud,
         CASE WHEN {_F1_HIT} THEN '{_reason(F1_RULE)}' END AS fraud_reason
  FROM clean
),
lake AS (
  SELECT *, CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
         CAST(day(event_time) AS INTEGER) AS day
  FROM flagged WHERE NOT is_fraud
)"""

EVENT_COLS = ("order_id, customer_id, amount, currency, product_category, customer_tenure_days, "
              "customer_email, customer_country, \"timestamp\", event_type")

SQL["decode_orders"] = f"WITH {F1_CTE} SELECT * FROM f1"
SQL["validate_orders"] = f"WITH {F1_CTE} SELECT * FROM clean"
SQL["flag_fraud"] = f"WITH {F1_CTE} SELECT * FROM flagged"
SQL["fraud_orders"] = f"WITH {F1_CTE} SELECT * FROM flagged WHERE is_fraud"
SQL["valid_orders"] = f"WITH {F1_CTE} SELECT * FROM flagged WHERE NOT is_fraud"

SQL["fraud_alert_json"] = f"""WITH {F1_CTE}
SELECT {EVENT_COLS}, date_trunc('millisecond', kafka_timestamp) AS kafka_timestamp,
       date_trunc('millisecond', event_time) AS event_time, is_fraud, fraud_reason
FROM flagged WHERE is_fraud"""

SQL["keyed_order_json"] = f"WITH {F1_CTE} SELECT customer_id AS key, {EVENT_COLS} FROM f1"

_WINDOW_SUM = "sum(CAST(amount AS DECIMAL(38,10)))"
_WINDOW_SQL = f"""WITH {F1_CTE}
SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
       time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
       product_category,
       CAST({_WINDOW_SUM} AS DOUBLE) AS total_revenue, count(*) AS order_count,
       CAST({_WINDOW_SUM} AS DOUBLE) / NULLIF(count(amount), 0) AS avg_order_value
FROM clean GROUP BY time_bucket(INTERVAL '5 minutes', event_time), product_category"""
SQL["window_revenue"] = _WINDOW_SQL
SQL["stream_window_revenue"] = _WINDOW_SQL

SQL["conform_columns"] = f"""WITH {F1_CTE}
SELECT order_id, customer_id, CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS VARCHAR) AS product_name,
       product_category AS category, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS INTEGER) AS quantity,
       CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount, event_time AS order_timestamp,
       customer_tenure_days AS customer_age_days, is_fraud, fraud_reason,
       CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
       CAST(day(event_time) AS INTEGER) AS day, CAST(NULL AS VARCHAR) AS source_file
FROM flagged"""

SQL["scan_parquet_valid"] = f"WITH {F1_CTE} SELECT * FROM lake"
SQL["stream_valid_parquet"] = f"WITH {F1_CTE} SELECT * FROM lake"
SQL["partition_counts"] = f"""WITH {F1_CTE}
SELECT year, month, day, count(*) AS order_count FROM lake GROUP BY year, month, day"""
SQL["partition_pruned_scan"] = f"""WITH {F1_CTE}
SELECT * FROM lake WHERE event_time >= TIMESTAMP '2024-01-10 00:00:00' AND event_time < TIMESTAMP '2024-01-20 00:00:00'"""

# --- warehouse load (F2) -----------------------------------------------------------

RAW_COLS = ("order_id, customer_id, product_id, product_name, category, CAST(price AS DOUBLE) AS price, "
            "quantity, CAST(amount AS DOUBLE) AS amount, order_timestamp, customer_age_days, is_fraud, "
            "fraud_reason, year, month, day, loaded_at, source_file")
STG_COLS = ("order_id, customer_id, product_id, quantity, CAST(price AS DOUBLE) AS price, "
            "CAST(total_amount AS DOUBLE) AS total_amount, order_timestamp, customer_age_days, is_fraud, "
            "processed_time, order_date, order_hour, order_day_of_week")

_GATE = ("NULLIF(concat_ws(',', "
         "CASE WHEN order_id IS NULL THEN 'order_id_not_null' END, "
         "CASE WHEN customer_id IS NULL THEN 'customer_id_not_null' END, "
         "CASE WHEN product_id IS NULL THEN 'product_id_not_null' END, "
         "CASE WHEN order_timestamp IS NULL THEN 'order_timestamp_not_null' END, "
         "CASE WHEN NOT coalesce(length(order_id) <= 50, true) THEN 'order_id_width' END, "
         "CASE WHEN NOT coalesce(length(customer_id) <= 50, true) THEN 'customer_id_width' END, "
         "CASE WHEN NOT coalesce(length(product_id) <= 50, true) THEN 'product_id_width' END, "
         "CASE WHEN NOT coalesce(price >= 0, true) THEN 'price_non_negative' END, "
         "CASE WHEN NOT coalesce(quantity > 0, true) THEN 'quantity_positive' END, "
         "CASE WHEN NOT coalesce(amount >= 0, true) THEN 'amount_non_negative' END, "
         "CASE WHEN NOT coalesce(customer_age_days >= 0, true) THEN 'age_non_negative' END), '')")

SQL["constraint_gate"] = f"""WITH {RAW_CTE}
SELECT {RAW_COLS}, {_GATE} AS violations, {_GATE} IS NULL AS passed FROM raw"""

SQL["insert_if_absent"] = f"""WITH {RAW_CTE}
SELECT {RAW_COLS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY order_id
    ORDER BY loaded_at NULLS FIRST, source_file NULLS FIRST, product_id NULLS FIRST, amount NULLS FIRST,
             quantity NULLS FIRST, customer_id NULLS FIRST, product_name NULLS FIRST, category NULLS FIRST,
             price NULLS FIRST, order_timestamp NULLS FIRST, customer_age_days NULLS FIRST,
             is_fraud NULLS FIRST, fraud_reason NULLS FIRST, year NULLS FIRST, month NULLS FIRST,
             day NULLS FIRST) AS rn
  FROM raw WHERE order_id IS NOT NULL) t
WHERE rn = 1"""

# --- quality and profiles -------------------------------------------------------------

_FN = f"(amount > {F2_RULE.amount_threshold} AND customer_age_days < {F2_RULE.tenure_days} AND is_fraud = FALSE)"
_FP = f"((amount <= {F2_RULE.amount_threshold} OR customer_age_days >= {F2_RULE.tenure_days}) AND is_fraud = TRUE)"
_NULLS = ("count(*) FILTER (WHERE order_id IS NULL)", "count(*) FILTER (WHERE customer_id IS NULL)",
          "count(*) FILTER (WHERE amount IS NULL)", "count(*) FILTER (WHERE order_timestamp IS NULL)")
_NULL_SUM = " + ".join(_NULLS)
_EMPTY_PARTS = ("(CASE WHEN count(DISTINCT year) = 0 THEN 1 ELSE 0 END + CASE WHEN count(DISTINCT month) = 0 "
                "THEN 1 ELSE 0 END + CASE WHEN count(DISTINCT day) = 0 THEN 1 ELSE 0 END)")
_S_FN = f"(total_amount > {F2_RULE.amount_threshold} AND customer_age_days < {F2_RULE.tenure_days} AND is_fraud = FALSE)"
_S_FP = f"(total_amount <= {F2_RULE.amount_threshold} AND customer_age_days >= {F2_RULE.tenure_days} AND is_fraud = TRUE)"

_CHECK_BODIES = {
    "check_row_counts": "SELECT count(*) AS row_count, count(*) > 0 AS passed, "
                        "CAST(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS n_failed FROM raw",
    "check_nulls": f"SELECT {_NULLS[0]} AS null_order_id, {_NULLS[1]} AS null_customer_id, "
                   f"{_NULLS[2]} AS null_amount, {_NULLS[3]} AS null_timestamp, ({_NULL_SUM}) = 0 AS passed, "
                   f"CAST({_NULL_SUM} AS BIGINT) AS n_failed FROM raw",
    "check_ranges": "SELECT CAST(min(amount) AS DOUBLE) AS min_amount, CAST(max(amount) AS DOUBLE) AS max_amount, "
                    "min(order_timestamp) AS min_date, max(order_timestamp) AS max_date, "
                    "count(*) FILTER (WHERE amount < 0) AS negative_count, "
                    "count(*) FILTER (WHERE amount < 0) = 0 AS passed, "
                    "CAST(count(*) FILTER (WHERE amount < 0) AS BIGINT) AS n_failed FROM raw",
    "check_fraud_logic": f"SELECT count(*) FILTER (WHERE {_FN}) AS false_negatives, "
                         f"count(*) FILTER (WHERE {_FP}) AS false_positives, "
                         f"count(*) FILTER (WHERE {_FN}) + count(*) FILTER (WHERE {_FP}) = 0 AS passed, "
                         f"CAST(count(*) FILTER (WHERE {_FN}) + count(*) FILTER (WHERE {_FP}) AS BIGINT) AS n_failed "
                         f"FROM raw",
    "check_partitions": f"SELECT count(DISTINCT year) AS years, count(DISTINCT month) AS months, "
                        f"count(DISTINCT day) AS days, {_EMPTY_PARTS} = 0 AS passed, "
                        f"CAST({_EMPTY_PARTS} AS BIGINT) AS n_failed FROM raw",
}
for _name, _body in _CHECK_BODIES.items():
    SQL[_name] = f"WITH {RAW_CTE} {_body}"

SQL["check_duplicates"] = f"""WITH {RAW_CTE}
SELECT order_id, count(*) AS cnt FROM raw GROUP BY order_id HAVING count(*) > 1"""

SQL["test_unique"] = f"""WITH {STG_CTE}
SELECT order_id AS unique_field, count(*) AS n_records FROM stg
WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1"""

SQL["test_not_null"] = f"WITH {RAW_CTE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {RAW_COLS} FROM raw WHERE {c} IS NULL"
    for c in ("order_id", "customer_id", "amount", "order_timestamp"))

SQL["test_accepted_range"] = f"""WITH {STG_CTE}
SELECT {STG_COLS} FROM stg WHERE NOT (total_amount >= 0 AND total_amount <= 10000)"""

SQL["check_volume"] = f"WITH {STG_CTE} SELECT count(*) AS row_count FROM stg HAVING count(*) < 100"

SQL["test_fraud_accuracy"] = f"""WITH {STG_CTE}
SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, customer_age_days, is_fraud
FROM stg WHERE {_S_FN} OR {_S_FP}"""

_FRESHNESS = """WITH {stg}
SELECT {cols} FROM stg
WHERE NOT (processed_time BETWEEN TIMESTAMP '1998-12-31 23:30:00' AND TIMESTAMP '1999-01-01 00:30:00')"""

_ACCEPTED = "'electronics', 'clothing', 'books', 'home', 'sports'"

SQL["test_accepted_values"] = f"""WITH {F1_CTE}
SELECT {EVENT_COLS} FROM f1 WHERE product_category NOT IN ({_ACCEPTED})"""

SQL["test_category_range"] = f"""WITH {F1_CTE},
ranges(_cat, _lo, _hi) AS (VALUES ('electronics', 50.0, 2000.0), ('clothing', 20.0, 300.0),
                                 ('books', 10.0, 50.0), ('home', 30.0, 500.0), ('sports', 25.0, 400.0)),
j AS (
  SELECT {EVENT_COLS},
         CASE WHEN r._cat IS NULL THEN 'unknown_category'
              WHEN NOT (amount BETWEEN r._lo AND r._hi) THEN 'out_of_range' END AS violation
  FROM f1 LEFT JOIN ranges r ON f1.product_category = r._cat
)
SELECT * FROM j WHERE violation IS NOT NULL"""


def _summary_row(name: str, body: str, report: bool) -> str:
    if report:
        return f"SELECT '{name}' AS \"check\", passed, n_failed, CAST(NULL AS VARCHAR) AS error FROM ({body}) s"
    return (f"SELECT '{name}' AS \"check\", count(*) = 0 AS passed, count(*) AS n_failed, "
            f"CAST(NULL AS VARCHAR) AS error FROM ({body}) s")


_SUMMARY_PARTS = [_summary_row(n, _CHECK_BODIES[n], True) for n in
                  ("check_row_counts", "check_nulls")] + [
    _summary_row("check_duplicates", "SELECT order_id FROM raw GROUP BY order_id HAVING count(*) > 1", False),
    _summary_row("check_ranges", _CHECK_BODIES["check_ranges"], True),
    _summary_row("check_fraud_logic", _CHECK_BODIES["check_fraud_logic"], True),
    _summary_row("check_partitions", _CHECK_BODIES["check_partitions"], True),
    _summary_row("test_unique_order_id", "SELECT order_id FROM stg WHERE order_id IS NOT NULL "
                                         "GROUP BY order_id HAVING count(*) > 1", False),
    _summary_row("test_not_null_order_id", " UNION ALL ".join(
        f"SELECT order_id FROM stg WHERE {c} IS NULL" for c in ("order_id", "total_amount", "order_date")), False),
    _summary_row("test_accepted_range_total_amount",
                 "SELECT order_id FROM stg WHERE NOT (total_amount >= 0 AND total_amount <= 10000)", False),
    _summary_row("test_fraud_accuracy", f"SELECT order_id FROM stg WHERE {_S_FN} OR {_S_FP}", False),
    _summary_row("check_volume", "SELECT count(*) AS row_count FROM stg HAVING count(*) < 100", False),
]
SQL["quality_summary"] = f"WITH {STG_CTE} " + " UNION ALL ".join(_SUMMARY_PARTS)

SQL["order_totals"] = f"""WITH {RAW_CTE}
SELECT count(*) AS total_rows, count(DISTINCT order_id) AS distinct_orders,
       count(DISTINCT customer_id) AS distinct_customers,
       count(*) FILTER (WHERE is_fraud) AS fraud_orders,
       CAST(sum(amount) AS DOUBLE) AS total_revenue,
       {money_avg_2('sum(amount)', 'count(amount)')} AS avg_order_value,
       CAST(min(order_timestamp) AS DATE) AS earliest, CAST(max(order_timestamp) AS DATE) AS latest
FROM raw"""

SQL["category_counts"] = f"WITH {RAW_CTE} SELECT category, count(*) AS order_count FROM raw GROUP BY category"

SQL["latest_orders"] = f"""WITH {RAW_CTE}
SELECT order_id, category, product_name, CAST(amount AS DOUBLE) AS amount, is_fraud, order_timestamp
FROM raw ORDER BY order_timestamp DESC, order_id, product_id, amount LIMIT 5"""

_CUSTOMERS_CTE = f"""{STG_CTE},
cust AS (
  SELECT customer_id, min(order_timestamp) AS first_order_date, max(order_timestamp) AS last_order_date,
         count(DISTINCT order_id) AS total_orders, sum(total_amount) AS lifetime_value,
         {money_avg_2('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
         max(customer_age_days) AS current_age_days, {segment('max(customer_age_days)')} AS customer_segment
  FROM stg GROUP BY customer_id
)"""

SQL["test_unique_customers"] = f"""WITH {_CUSTOMERS_CTE}
SELECT customer_id AS unique_field, count(*) AS n_records FROM cust
WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1"""

SQL["test_not_null_models"] = f"WITH {_CUSTOMERS_CTE} " + " UNION ALL ".join(
    [f"SELECT 'stg_orders' AS model, '{c}' AS column_name, order_id AS key FROM stg WHERE {c} IS NULL"
     for c in ("order_id", "total_amount", "order_date")]
    + [f"SELECT 'stg_customers' AS model, '{c}' AS column_name, customer_id AS key FROM cust WHERE {c} IS NULL"
       for c in ("customer_id", "lifetime_value")])

SQL["test_accepted_range_lifetime_value"] = f"""WITH {_CUSTOMERS_CTE}
SELECT customer_id, first_order_date, last_order_date, total_orders, CAST(lifetime_value AS DOUBLE) AS lifetime_value,
       avg_order_value, current_age_days, customer_segment
FROM cust WHERE NOT (lifetime_value >= 0)"""


# --- inputs with bad rows ----------------------------------------------------------
# Twins of fixtures.mixed_topic and fixtures.mixed_raw_orders (same cases by key).

_CATEGORY_CASES = " ".join(f"WHEN {8 + i} THEN '{CATEGORIES[i % len(CATEGORIES)]}'" for i in range(10))
MIXED_F1_CTE = F1_CTE.replace("f1 AS (", "f0 AS (", 1).replace("  FROM events\n", "  , event_id % 50 AS m FROM events\n", 1).replace(
    "clean AS (", f"""f1 AS (
  SELECT CASE WHEN m IN (1, 6) THEN NULL ELSE order_id END AS order_id,
         CASE WHEN m IN (1, 5) THEN NULL ELSE customer_id END AS customer_id,
         CASE m WHEN 1 THEN NULL WHEN 3 THEN -amount WHEN 7 THEN NULL WHEN 21 THEN 0.0 WHEN 23 THEN 'NaN'::DOUBLE
                WHEN 24 THEN 'Infinity'::DOUBLE WHEN 25 THEN 1e11 ELSE amount END AS amount,
         CASE WHEN m = 1 THEN NULL ELSE currency END AS currency,
         CASE m WHEN 1 THEN NULL {_CATEGORY_CASES} ELSE product_category END AS product_category,
         CASE m WHEN 1 THEN NULL WHEN 4 THEN -1 WHEN 22 THEN NULL ELSE customer_tenure_days END AS customer_tenure_days,
         customer_email, customer_country,
         CASE m WHEN 1 THEN NULL WHEN 2 THEN 'not a time' ELSE "timestamp" END AS "timestamp",
         CASE WHEN m = 1 THEN NULL ELSE event_type END AS event_type,
         kafka_timestamp, CASE WHEN m IN (1, 2) THEN NULL ELSE event_time END AS event_time
  FROM f0
),
clean AS (""", 1)

MIXED_RAW_CTE = RAW_CTE.replace("raw AS (", "raw0 AS (", 1) + """,
raw AS (
  SELECT CASE WHEN k = 1 THEN NULL ELSE order_id END AS order_id,
         CASE WHEN k = 2 THEN NULL ELSE customer_id END AS customer_id,
         CASE WHEN k = 9 THEN NULL ELSE product_id END AS product_id, product_name,
         CASE WHEN k = 13 THEN repeat('x', 101) ELSE category END AS category,
         CAST(CASE WHEN k = 12 THEN -price ELSE price END AS DECIMAL(10,2)) AS price,
         CASE WHEN k = 6 THEN 0 ELSE quantity END AS quantity,
         CAST(CASE k WHEN 3 THEN NULL WHEN 5 THEN -amount WHEN 11 THEN amount + 2000000000 ELSE amount END AS DECIMAL(12,2)) AS amount,
         CASE WHEN k = 4 THEN NULL ELSE order_timestamp END AS order_timestamp,
         CASE WHEN k = 10 THEN -1 ELSE customer_age_days END AS customer_age_days,
         CASE WHEN k = 7 THEN NOT is_fraud ELSE is_fraud END AS is_fraud, fraud_reason, year, month, day,
         CASE WHEN k = 8 THEN TIMESTAMP '1998-12-30 00:00:00' ELSE loaded_at END AS loaded_at, source_file
  FROM (SELECT *, (CAST(split_part(order_id, '-', 1) AS BIGINT) * 7 + CAST(split_part(order_id, '-', 2) AS BIGINT)) % 60 AS k,
               unnest(CASE WHEN (CAST(split_part(order_id, '-', 1) AS BIGINT) * 7 + CAST(split_part(order_id, '-', 2) AS BIGINT)) % 60 = 20
                           THEN [1, 2] ELSE [1] END) AS copy
        FROM raw0) keyed
)"""
_STG_TAIL = STG_CTE[len(RAW_CTE):].replace("CAST(amount AS DECIMAL(10,2))", "TRY_CAST(amount AS DECIMAL(10,2))").replace("FROM raw WHERE order_timestamp IS NOT NULL",
                                           "FROM raw WHERE order_timestamp IS NOT NULL AND (amount IS NULL OR abs(amount) < 100000000)")
MIXED_STG_CTE = MIXED_RAW_CTE + _STG_TAIL
SQL["test_freshness"] = _FRESHNESS.replace("{stg}", MIXED_STG_CTE).replace("{cols}", STG_COLS)

SQL["decode_mixed"] = f"""WITH {MIXED_F1_CTE}
SELECT * REPLACE (CASE WHEN isnan(amount) THEN NULL ELSE amount END AS amount) FROM f1"""
SQL["validate_mixed"] = f"WITH {MIXED_F1_CTE} SELECT * FROM clean"
SQL["rejected_orders"] = f"""WITH {MIXED_F1_CTE}, tested AS (
  SELECT order_id, customer_id, event_time, kafka_timestamp,
         CASE WHEN NOT coalesce(amount > 0, false) THEN 'amount_not_positive'
              WHEN NOT isfinite(amount) THEN 'amount_not_finite'
              WHEN NOT coalesce(customer_tenure_days >= 0, false) THEN 'tenure_negative'
              WHEN event_time IS NULL THEN 'no_event_time' WHEN order_id IS NULL THEN 'no_order_id'
              WHEN customer_id IS NULL THEN 'no_customer_id' END AS reject_reason
  FROM f1)
SELECT * FROM tested WHERE reject_reason IS NOT NULL"""
SQL["window_revenue_mixed"] = f"""WITH {MIXED_F1_CTE}, money AS (
  SELECT *, CASE WHEN isfinite(amount) THEN CAST(amount AS DECIMAL(38,10)) END AS exact FROM f1 WHERE event_time IS NOT NULL)
SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
       time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end, product_category,
       CAST(sum(exact) AS DOUBLE) AS total_revenue, count(*) AS order_count,
       CAST(sum(exact) AS DOUBLE) / NULLIF(count(exact), 0) AS avg_order_value
FROM money GROUP BY ALL"""
SQL["warehouse_gate_mixed"] = f"""WITH {MIXED_F1_CTE}, fitted AS (
  SELECT order_id, product_category AS category, TRY_CAST(amount AS DECIMAL(12,2)) AS fit, event_time AS order_timestamp FROM flagged)
SELECT order_id, category, CAST(fit AS DOUBLE) AS amount, order_timestamp,
       CASE WHEN fit IS NULL THEN 'amount_unfit' END AS violations, fit IS NOT NULL AS passed FROM fitted"""
SQL["accepted_values_mixed"] = f"WITH {MIXED_F1_CTE} SELECT * FROM clean WHERE product_category NOT IN ({_ACCEPTED})"
SQL["category_range_mixed"] = f"""WITH {MIXED_F1_CTE},
ranges(_cat, _lo, _hi) AS (VALUES {', '.join(f"('{k}', {float(lo)}, {float(hi)})" for k, (lo, hi) in CATEGORY_PRICE_RANGES.items())}),
j AS (SELECT clean.*, CASE WHEN _cat IS NULL THEN 'unknown_category' WHEN amount < _lo OR amount > _hi THEN 'out_of_range' END AS violation
      FROM clean LEFT JOIN ranges ON product_category = _cat)
SELECT * FROM j WHERE violation IS NOT NULL"""
SQL["event_structure_mixed"] = f"""WITH {MIXED_F1_CTE}, tested AS (
  SELECT order_id, customer_id, amount, customer_tenure_days,
         CASE WHEN amount IS NULL OR amount <= 0 THEN 'amount_not_positive'
              WHEN customer_tenure_days IS NULL OR customer_tenure_days < 1 THEN 'tenure_below_one' END AS violation
  FROM f1 WHERE NOT coalesce(isnan(amount), false))
SELECT * FROM tested WHERE violation IS NOT NULL"""

SQL["stg_orders_mixed"] = f"WITH {MIXED_STG_CTE} SELECT {STG_COLS} FROM stg"
SQL["staging_rejects"] = f"""WITH {MIXED_RAW_CTE}
SELECT order_id, CAST(amount AS DOUBLE) AS total_amount, 'total_amount_unfit' AS violations FROM raw WHERE abs(amount) >= 100000000"""
_GATE_WIDE = _GATE.replace(", '')", ", CASE WHEN length(category) > 100 THEN 'category_width' END), '')").replace(
    "END), CASE WHEN length(category)", "END, CASE WHEN length(category)")
SQL["constraint_gate_mixed"] = f"""WITH {MIXED_RAW_CTE}
SELECT order_id, customer_id, product_id, order_timestamp, {_GATE_WIDE} AS violations, {_GATE_WIDE} IS NULL AS passed FROM raw"""
SQL["insert_if_absent_mixed"] = f"""WITH {MIXED_RAW_CTE}
SELECT DISTINCT order_id FROM raw WHERE {_GATE} IS NULL"""
for _name in ("check_nulls", "check_ranges", "check_fraud_logic"):
    SQL[f"{_name}_mixed"] = f"WITH {MIXED_RAW_CTE} {_CHECK_BODIES[_name]}"
SQL["check_row_counts_rejects"] = f"WITH {RAW_CTE} {_CHECK_BODIES['check_row_counts']} WHERE price < 0 OR quantity <= 0 OR amount < 0 OR customer_age_days < 0"
SQL["check_partitions_unfilled"] = f"""WITH {MIXED_RAW_CTE}
SELECT count(DISTINCT year) AS years, count(DISTINCT month) AS months, CAST(0 AS BIGINT) AS days, false AS passed, CAST(1 AS BIGINT) AS n_failed FROM raw"""
SQL["check_duplicates_mixed"] = f"WITH {MIXED_RAW_CTE} SELECT order_id, count(*) AS cnt FROM raw GROUP BY order_id HAVING count(*) > 1"
SQL["test_not_null_mixed"] = f"WITH {MIXED_RAW_CTE} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, product_id, category, year FROM raw WHERE {c} IS NULL"
    for c in ("order_id", "customer_id", "amount", "order_timestamp"))
SQL["test_fraud_accuracy_mixed"] = SQL["test_fraud_accuracy"].replace(STG_CTE, MIXED_STG_CTE)
SQL["check_volume_short"] = f"WITH {MIXED_STG_CTE} SELECT count(*) AS row_count FROM stg HAVING count(*) < 1000000000"
_MIXED_CUSTOMERS = _CUSTOMERS_CTE.replace(STG_CTE, MIXED_STG_CTE)
SQL["test_accepted_range_lifetime_value_mixed"] = SQL["test_accepted_range_lifetime_value"].replace(
    _CUSTOMERS_CTE, _MIXED_CUSTOMERS).replace("lifetime_value >= 0", "lifetime_value >= 500000")
SQL["not_null_models_mixed"] = SQL["test_not_null_models"].replace(_CUSTOMERS_CTE, _MIXED_CUSTOMERS)
SQL["quality_summary_mixed"] = SQL["quality_summary"].replace(STG_CTE, MIXED_STG_CTE)
SQL["quality_summary_missing_column"] = f"""SELECT "check", coalesce(passed AND "check" <> 'check_partitions', false) AS passed,
       CASE WHEN "check" <> 'check_partitions' THEN n_failed END AS n_failed,
       CASE WHEN "check" = 'check_partitions' THEN 'missing or mistyped columns: year' END AS error
FROM ({SQL["quality_summary"]}) s"""
SQL["hourly_rollup"] = SQL["hourly_metrics"]
SQL["stored_failures"] = f"""WITH {MIXED_STG_CTE}
SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount FROM stg, (VALUES (1), (2)) runs(n)
WHERE NOT (total_amount >= 0 AND total_amount <= 10000)"""

# --- streams and loads -------------------------------------------------------------
_ON_TIME = """CAST(substr(order_id, 5) AS BIGINT) % 10 <> 0 OR time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes'
      > (SELECT max(event_time) FROM clean WHERE CAST(substr(order_id, 5) AS BIGINT) % 10 <> 0 AND event_time < TIMESTAMP '2024-01-20 00:00:00') - INTERVAL '10 minutes'"""
SQL["stream_late_data"] = _WINDOW_SQL.replace("FROM clean GROUP BY", f"FROM clean WHERE {_ON_TIME} GROUP BY")
SQL["stream_restart"] = _WINDOW_SQL
SQL["stream_open_windows"] = f"""WITH {F1_CTE}
SELECT DISTINCT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
       time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end, product_category
FROM clean WHERE time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes'
                 > (SELECT max(event_time) FROM clean) - INTERVAL '10 minutes'"""
SQL["stream_fanout"] = f"""SELECT 'window' AS output, product_category AS key, window_start AS at, total_revenue AS amount, order_count AS orders
FROM ({SQL["stream_late_data"]}) UNION ALL
(WITH {F1_CTE}
SELECT 'lake', order_id, event_time, amount, 1 FROM lake UNION ALL
SELECT 'alert', order_id, date_trunc('millisecond', event_time), amount, 1 FROM flagged WHERE is_fraud UNION ALL
SELECT 'late', NULL, NULL, NULL, count(*) FROM clean WHERE NOT ({_ON_TIME}))"""

# Offsets of the topic in four partitions: dense, in the order of time and event.
_TOPIC_CTE = f"""{F1_CTE}, topic AS (
  SELECT f1.*, CAST(substr(customer_id, 6) AS BIGINT) % 4 AS part, CAST(substr(order_id, 5) AS BIGINT) AS event FROM f1
)"""
SQL["topic_peek"] = f"""WITH {_TOPIC_CTE}
SELECT customer_id AS key, CAST(part AS INTEGER) AS partition,
       row_number() OVER (PARTITION BY part ORDER BY event_time, event) - 1 AS "offset", order_id, amount
FROM topic ORDER BY 2, 3 LIMIT 1000"""
SQL["topic_from_latest"] = f"""WITH {_TOPIC_CTE}
SELECT order_id, CAST(part AS INTEGER) AS partition, "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY event % 2, event_time, event) - 1 AS "offset" FROM topic
) WHERE event % 2 = 1"""
SQL["topic_batch_sizes"] = f"""WITH {_TOPIC_CTE}, n AS (SELECT count(*) AS n FROM topic WHERE event % 2 = 1)
SELECT 1000 AS offsets, n // 1000 AS batches FROM n WHERE n >= 1000 UNION ALL SELECT n % 1000, 1 FROM n WHERE n % 1000 > 0"""
SQL["load_batch_and_stream"] = f"""SELECT * EXCLUDE (source_file) FROM ({SQL["conform_columns"]}) c
WHERE CAST(substr(order_id, 5) AS BIGINT) % 2 = 1 OR NOT is_fraud"""
SQL["load_files"] = f"WITH {F1_CTE} SELECT count(*) AS rows, CAST(1 AS BIGINT) AS failed_files FROM lake"
SQL["load_ledger"] = f"""WITH {F1_CTE}, took AS (
  SELECT CASE WHEN CAST(substr(order_id, 5) AS BIGINT) % 3 = 0 THEN 1 ELSE 2 END AS load FROM lake
)
SELECT load, count(*) AS rows, CAST(load - 1 AS BIGINT) AS failed_files, count(*) AS inserted FROM took GROUP BY load UNION ALL
SELECT 3, 0, 0, 0 UNION ALL SELECT 0, count(*), 0, 0 FROM took"""
SQL["insert_if_absent_late_months"] = SQL["insert_if_absent"]
SQL["hourly_rollup_new_rows"] = SQL["hourly_metrics"]
SQL["model_views"] = f"""WITH {MIXED_STG_CTE},
summary AS (
  SELECT customer_id, {segment('max(customer_age_days)')} AS label, sum(total_amount) AS spent, count(DISTINCT order_id) AS total_orders
  FROM stg GROUP BY customer_id
)
SELECT o.customer_id, label AS customer_segment, CAST(spent AS DOUBLE) AS lifetime_value, total_orders, count_if(o.is_fraud) AS fraud_orders,
       {pct_2('count_if(o.is_fraud)', 'count(*)')} AS fraud_rate_pct,
       CASE WHEN {pct_2('count_if(o.is_fraud)', 'count(*)')} > 10 THEN 'high_risk' WHEN {pct_2('count_if(o.is_fraud)', 'count(*)')} >= 5 THEN 'medium_risk'
            ELSE 'low_risk' END AS risk_category
FROM stg o LEFT JOIN summary c ON o.customer_id = c.customer_id GROUP BY o.customer_id, label, spent, total_orders"""
