"""The same queries as SQL over the sample tables, for an independent engine.

The SQL is written from the datasets' definitions, not from the DataFrame code: roll-ups join first and
group afterwards, for instance. Money is exchanged as double.
"""

from __future__ import annotations

from martloom.functions.calendar import HOLIDAYS
from martloom.plans.checks import ROW_FLOORS
from martloom.plans.workload import CAPTURED_AS_OF, EARLY_AS_OF, HOLIDAY_SHIFT, LATE_START, SOME_DAYS
from martloom.sources.reference import COUNTRIES
from martloom.sources.sample import SAMPLE_PARAMS

_COUNTRY_ROWS = ",\n    ".join("(" + ", ".join(f"'{value}'" for value in row) + ")" for row in COUNTRIES)
_CODES = ", ".join(f"'{row[0]}'" for row in COUNTRIES)
_HOLIDAYS = ", ".join(f"DATE '{day}'" for day in HOLIDAYS)


_SAMPLE_SOURCES = f"""src_customers AS (
    SELECT c_custkey AS id, '  ' || c_name || ' ' AS name,
        ' ' || replace(c_name, '#', '.')
            || CASE WHEN c_mktsegment = 'MACHINERY' THEN '@Localhost ' ELSE '@Example.com ' END AS email,
        ' ' || lower([{_CODES}, 'X0', 'X1', 'X2', 'X3'][c_nationkey + 1]) AS country_code,
        TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 50 AS INTEGER)) AS created_at,
        TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 50 AS INTEGER)) AS loaded_at
    FROM customer),
src_orders AS (
    SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(10, 2)) AS amount,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'shipped' END AS status,
        o_orderdate AS created_at, o_orderdate AS loaded_at
    FROM orders),
src_payments AS (
    SELECT l_orderkey || '-' || l_linenumber AS id, l_orderkey AS order_id,
        CAST(l_extendedprice AS DECIMAL(10, 2)) AS amount,
        CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'paypal' WHEN 'R' THEN 'bank_transfer' END
            AS payment_method,
        CASE l_linestatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' END AS status,
        l_shipdate AS created_at, l_shipdate AS loaded_at
    FROM lineitem),"""

# Orders in two versions, without customer, below zero, without status; payments of missing orders.
_AWKWARD_SOURCES = (
    _SAMPLE_SOURCES.replace("src_orders AS", "plain_orders AS").replace("src_payments AS", "plain_payments AS")
    + """
two_versions AS (
    SELECT * FROM plain_orders
    UNION ALL SELECT * REPLACE (amount + 1 AS amount, 'shipped' AS status) FROM plain_orders WHERE id % 5 = 0),
src_orders AS (
    SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN customer_id + 1000000 ELSE customer_id END AS customer_id,
        CAST(CASE WHEN id % 11 = 0 THEN -amount ELSE amount END AS DECIMAL(10, 2)) AS amount,
        CASE WHEN id % 13 <> 0 THEN status END AS status)
    FROM two_versions),
src_payments AS (
    SELECT * REPLACE (CASE WHEN order_id % 9 = 0 THEN order_id + 100000000 ELSE order_id END AS order_id)
    FROM plain_payments),"""
)

# The newest version of every captured row that has not been deleted.
_CAPTURED_SOURCES = """
versions AS (
    SELECT user_id, ts, event_type, CAST(value AS DECIMAL(10, 2)) AS amount,
        ['customers', 'orders', 'payments'][user_id % 3 + 1] AS tab,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
    FROM events WHERE event_type <> 'click'),
newest AS (
    SELECT *, CASE event_type WHEN 'purchase' THEN 'completed' ELSE event_type END AS status
    FROM versions WHERE place = 1 AND event_type <> 'error'),
src_customers AS (
    SELECT user_id AS id, 'User ' || user_id AS name, 'user.' || user_id || '@example.com' AS email,
        'US' AS country_code, ts AS created_at, ts AS loaded_at
    FROM newest WHERE tab = 'customers'),
src_orders AS (
    SELECT user_id AS id, user_id - 1 AS customer_id, amount, status, ts AS created_at, ts AS loaded_at
    FROM newest WHERE tab = 'orders'),
src_payments AS (
    SELECT user_id AS id, user_id - 1 AS order_id, amount, 'credit_card' AS payment_method, status,
        ts AS created_at, ts AS loaded_at
    FROM newest WHERE tab = 'payments'),"""


def _ctes(as_of: object, start: object, sources: str) -> str:
    return f"""
WITH params AS (SELECT TIMESTAMP '{as_of}' AS as_of, TIMESTAMP '{start}' AS start_date),
countries(country_code, country_name, region, continent, iso_alpha3, currency_code, currency_name, phone_code,
    gdp_category) AS (VALUES
    {_COUNTRY_ROWS}),
{sources}
t_customers AS (
    SELECT id AS customer_id, trim(name) AS customer_name, lower(trim(email)) AS email,
        upper(trim(country_code)) AS country_code, created_at AS registered_at,
        CAST(created_at AS DATE) AS signup_date, loaded_at
    FROM src_customers, params
    WHERE loaded_at >= start_date AND name IS NOT NULL AND email IS NOT NULL AND created_at IS NOT NULL),
t_orders AS (
    SELECT id AS order_id, customer_id, amount AS order_amount, status AS order_status, created_at AS ordered_at,
        CAST(created_at AS DATE) AS order_date, loaded_at
    FROM src_orders, params
    WHERE loaded_at >= start_date AND customer_id IS NOT NULL AND amount IS NOT NULL AND status IS NOT NULL
        AND created_at IS NOT NULL),
t_payments AS (
    SELECT id AS payment_id, order_id, amount AS payment_amount, payment_method, status AS payment_status,
        created_at AS paid_at, CAST(created_at AS DATE) AS payment_date, loaded_at
    FROM src_payments, params
    WHERE loaded_at >= start_date AND order_id IS NOT NULL AND amount IS NOT NULL AND payment_method IS NOT NULL
        AND status IS NOT NULL AND created_at IS NOT NULL),
customer_orders AS (
    SELECT c.customer_id, c.customer_name, c.email, c.country_code, c.registered_at, c.signup_date,
        count(o.order_id) AS total_orders,
        coalesce(sum(o.order_amount) FILTER (WHERE o.order_status = 'completed'), 0) AS total_spent,
        min(o.ordered_at) AS first_order_date, max(o.ordered_at) AS last_order_date
    FROM t_customers c LEFT JOIN t_orders o ON o.customer_id = c.customer_id
    GROUP BY ALL),
customers_active AS (
    SELECT co.*, CASE WHEN last_order_date >= as_of - INTERVAL 30 DAY THEN 'active'
        WHEN last_order_date >= as_of - INTERVAL 90 DAY THEN 'dormant' ELSE 'inactive' END AS activity_status
    FROM customer_orders co, params),
order_payments AS (
    SELECT o.order_id, o.customer_id, o.order_amount, o.order_status, o.ordered_at,
        count(p.payment_id) AS payment_count, sum(p.payment_amount) AS total_paid_amount,
        max(p.paid_at) AS last_payment_date, count(DISTINCT p.payment_method) AS distinct_payment_methods
    FROM t_orders o LEFT JOIN t_payments p ON p.order_id = o.order_id
    GROUP BY ALL),
orders_paid AS (
    SELECT *, CASE WHEN payment_count = 0 THEN 'unpaid' WHEN total_paid_amount >= order_amount THEN 'fully_paid'
        ELSE 'partially_paid' END AS payment_status
    FROM order_payments),
dim AS (
    SELECT ca.*,
        date_diff('day', CAST(registered_at AS DATE), CAST(coalesce(last_order_date, as_of) AS DATE)) AS lifetime,
        CASE WHEN total_spent >= {SAMPLE_PARAMS.tier_vip} THEN 'VIP'
            WHEN total_spent >= {SAMPLE_PARAMS.tier_premium} THEN 'Premium'
            WHEN total_spent >= {SAMPLE_PARAMS.tier_regular} THEN 'Regular'
            WHEN total_spent > 0 THEN 'New' ELSE 'Prospect' END AS customer_tier,
        as_of
    FROM customers_active ca, params),
dim_out AS (
    SELECT customer_id, customer_name, email, country_code, registered_at, signup_date, total_orders, total_spent,
        first_order_date, last_order_date, activity_status, CAST(lifetime AS INTEGER) AS customer_lifetime_days,
        customer_tier,
        CASE WHEN total_orders = 0 THEN 0 ELSE CAST(lifetime AS DOUBLE) / total_orders END AS days_between_orders,
        as_of AS dbt_loaded_at
    FROM dim),
dim_geo AS (
    SELECT d.*, k.country_name, k.region, k.continent, k.currency_code, k.currency_name, k.gdp_category,
        coalesce(g.label, 'Other') AS continent_group,
        CASE k.gdp_category WHEN 'High Income' THEN 'Tier 1' WHEN 'Upper Middle Income' THEN 'Tier 2' ELSE 'Tier 3'
            END AS economic_tier
    FROM dim_out d LEFT JOIN countries k ON k.country_code = d.country_code
    LEFT JOIN (VALUES ('North America', 'NA'), ('Europe', 'EU'), ('Asia', 'AS'), ('South America', 'SA'),
        ('Africa', 'AF'), ('Oceania', 'OC')) AS g(name, label) ON g.name = k.continent),
fct AS (
    SELECT o.order_id, o.customer_id, d.customer_name, d.customer_tier, d.activity_status, o.order_amount,
        o.order_status, p.payment_count, p.total_paid_amount, p.payment_status, p.distinct_payment_methods,
        CASE WHEN o.order_status = 'completed' THEN o.order_amount ELSE 0 END AS net_revenue,
        CASE WHEN p.payment_status = 'fully_paid' THEN o.order_amount ELSE 0 END AS paid_amount,
        o.order_amount - coalesce(p.total_paid_amount, 0) AS outstanding_amount,
        o.ordered_at, o.order_date, CAST(year(o.ordered_at) AS INTEGER) AS order_year,
        CAST(month(o.ordered_at) AS INTEGER) AS order_month,
        CAST(isodow(o.ordered_at) AS INTEGER) AS order_day_of_week,
        o.loaded_at AS source_loaded_at, as_of AS dbt_loaded_at
    FROM t_orders o CROSS JOIN params LEFT JOIN dim_out d ON d.customer_id = o.customer_id
        LEFT JOIN orders_paid p ON p.order_id = o.order_id),
cdc AS (
    SELECT event_id, user_id, ts, event_type, CAST(CAST(value AS DECIMAL(10, 2)) AS DOUBLE) AS amount,
        ['customers', 'orders', 'payments'][user_id % 3 + 1] AS tab,
        CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'u' WHEN 'view' THEN 'r' END AS op
    FROM events WHERE event_type IN ('signup', 'purchase', 'view'))
"""


def _sql(
    select: str,
    as_of: object = SAMPLE_PARAMS.as_of,
    start: object = SAMPLE_PARAMS.start_date,
    sources: str = _SAMPLE_SOURCES,
) -> str:
    return _ctes(as_of, start, sources) + select


def _doubles(relation: str, *money: str) -> str:
    casts = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in money)
    return f"SELECT * REPLACE ({casts}) FROM {relation}"


def _check(name: str, violations: str) -> str:
    """One check from a scalar subquery."""
    return f"SELECT '{name}' AS check_name, v AS violations, v = 0 AS passed FROM (SELECT ({violations}) AS v)"


_STG_ORDERS = _doubles("t_orders", "order_amount")
_INVALID = "FROM dim_out WHERE email NOT LIKE '%@%.%'"
_METRICS = f"""
SELECT customer_id, customer_name, email, customer_tier, activity_status, total_orders,
    CAST(total_spent AS DOUBLE) AS total_spent, first_order_date, last_order_date, customer_lifetime_days,
    days_between_orders,
    CASE WHEN total_orders > 0 THEN CAST(total_spent AS DOUBLE) / total_orders ELSE 0 END AS avg_order_value,
    CASE WHEN age <= 30 THEN 'Active' WHEN age <= 90 THEN 'Warm' ELSE 'Cold' END AS recency_segment,
    CASE WHEN total_orders >= 10 THEN 'High' WHEN total_orders >= 5 THEN 'Medium' ELSE 'Low' END AS frequency_segment,
    CASE WHEN total_spent >= {SAMPLE_PARAMS.monetary_high} THEN 'High'
        WHEN total_spent >= {SAMPLE_PARAMS.monetary_medium} THEN 'Medium' ELSE 'Low' END AS monetary_segment,
    dbt_loaded_at
FROM (SELECT *, date_diff('day', CAST(last_order_date AS DATE), CAST(dbt_loaded_at AS DATE)) AS age FROM dim_out)"""

_NOT_NULL = " UNION ALL ".join(
    _check(f"not_null:{table}.{column}", f"SELECT count(*) FROM src_{table} WHERE {column} IS NULL")
    for table, columns in {
        "customers": ["name", "email"],
        "orders": ["customer_id", "amount", "status"],
        "payments": ["order_id", "amount", "payment_method", "status"],
    }.items()
    for column in columns
)
_UNIQUE = " UNION ALL ".join(
    _check(
        f"unique:{table}.{column}",
        f"SELECT count(*) FROM (SELECT {column} FROM src_{table} WHERE {column} IS NOT NULL"
        f" GROUP BY {column} HAVING count(*) > 1)",
    )
    for table, column in [("customers", "id"), ("orders", "id"), ("payments", "id"), ("customers", "email")]
)
_REFERENCES = " UNION ALL ".join(
    _check(
        f"references:{table}.{column}->{parent}.id",
        f"SELECT count(*) FROM src_{table} c WHERE {column} IS NOT NULL"
        f" AND NOT EXISTS (SELECT 1 FROM src_{parent} p WHERE p.id = c.{column})",
    )
    for table, column, parent in [("orders", "customer_id", "customers"), ("payments", "order_id", "orders")]
)
_NON_NEGATIVE = _check("non_negative:orders.amount", "SELECT count(*) FROM src_orders WHERE amount < 0")
_INVALID_EMAILS = _check("invalid_emails", f"SELECT count(*) {_INVALID}")
_FRESHNESS = _check(
    "orders_freshness",
    "SELECT CAST(max(created_at) IS NULL AS BIGINT) FROM src_orders, params"
    " WHERE created_at >= as_of - INTERVAL 2 HOUR",
)
_FLOORS = " UNION ALL ".join(
    _check(f"row_floor:{name}", f"SELECT greatest({floor} - count(*), 0) FROM {relation}")
    for (name, floor), relation in zip(ROW_FLOORS.items(), ("t_customers", "dim_out", "fct"))
)
_ALL_CHECKS = " UNION ALL ".join([_NOT_NULL, _UNIQUE, _REFERENCES, _NON_NEGATIVE, _INVALID_EMAILS, _FRESHNESS])

_DATES = f"""
SELECT d AS date, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
    isodow(d) IN (6, 7) AS is_weekend, d IN ({_HOLIDAYS}) AS is_holiday,
    isodow(d) < 6 AND d NOT IN ({_HOLIDAYS}) AS is_business_day,
    CAST(least(52, (dayofyear(d) + 6) // 7) AS INTEGER) AS week_of_year,
    ['Winter', 'Spring', 'Summer', 'Autumn'][month(d) % 12 // 3 + 1] AS season,
    CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(CAST(min(order_date) AS TIMESTAMP), CAST(max(order_date) AS TIMESTAMP),
    INTERVAL 1 DAY)) AS DATE) AS d FROM t_orders)"""
_REVENUE_MISMATCHES = "SELECT count(*) FROM fct WHERE order_status = 'completed' AND net_revenue <> order_amount"

_CAPTURED = {
    "customers": "event_id AS id, 'User ' || user_id AS name, 'user.' || user_id || '@example.com' AS email, "
    "'US' AS country_code, ts AS created_at",
    "orders": "event_id AS id, user_id AS customer_id, amount, event_type AS status, ts AS created_at",
    "payments": "event_id AS id, user_id AS order_id, amount, 'credit_card' AS payment_method, "
    "event_type AS status, ts AS created_at",
}
_PARSED = (
    "event_id AS id, 'User ' || user_id AS name, 'user.' || user_id || '@example.com' AS email, "
    "'US' AS country_code, user_id AS customer_id, user_id AS order_id, amount, 'credit_card' AS payment_method, "
    'event_type AS status, ts AS created_at, tab AS "table", ts AS processed_at, CAST(0 AS BIGINT) AS sequence'
)


# A change does not follow from the one seen before it in its row. Every seventh change is not seen.
_GAPS = """
WITH chain AS (
    SELECT event_id, user_id, ts, event_type, {'t': ts, 'a': CAST(value AS DECIMAL(10, 2)), 'e': event_type} AS image,
        lag(event_type) OVER w AS type_before, lag({'t': ts, 'a': CAST(value AS DECIMAL(10, 2)), 'e': event_type}) OVER w AS image_before
    FROM events WHERE event_type <> 'click' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
changes AS (
    SELECT *, CASE WHEN type_before IS NULL OR type_before = 'error' THEN 'c' WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op
    FROM chain),
seen AS (
    SELECT *, lag(op) OVER w AS seen_op, lag(image) OVER w AS seen_image
    FROM changes WHERE event_id % 7 <> 0 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
judged AS (
    SELECT *, CASE WHEN op <> 'c' AND seen_op IS NULL THEN 'unseen' WHEN op <> 'c' AND seen_op = 'd' THEN 'deleted'
        WHEN op = 'c' AND seen_op <> 'd' THEN 'exists' WHEN op <> 'c' AND image_before IS DISTINCT FROM seen_image THEN 'differs' END AS reason
    FROM seen)
SELECT ['customers', 'orders', 'payments'][user_id % 3 + 1] AS "table", user_id AS id, op, reason, ts AS processed_at, event_id AS sequence
FROM judged WHERE reason IS NOT NULL"""


_FCT_PAYMENTS = """
SELECT p.payment_id, p.order_id, f.customer_id, f.customer_name, f.customer_tier,
    CAST(p.payment_amount AS DOUBLE) AS payment_amount, p.payment_method, p.payment_status,
    CAST(f.order_amount AS DOUBLE) AS order_amount, f.order_status, p.paid_at, p.payment_date,
    CASE p.payment_status WHEN 'completed' THEN 1 ELSE 0 END AS is_successful_payment,
    p.loaded_at AS source_loaded_at, as_of AS dbt_loaded_at
FROM t_payments p CROSS JOIN params LEFT JOIN fct f ON f.order_id = p.order_id"""
_DAILY = """
SELECT order_date, order_year, order_month, count(order_id) AS daily_orders,
    count(DISTINCT customer_id) AS daily_customers, CAST(sum(net_revenue) AS DOUBLE) AS daily_revenue,
    CAST(sum(net_revenue) AS DOUBLE) / count(net_revenue) AS avg_order_value,
    CAST(sum(CASE WHEN customer_tier = 'VIP' THEN net_revenue ELSE 0 END) AS DOUBLE) AS vip_revenue,
    CAST(sum(CASE WHEN customer_tier = 'Premium' THEN net_revenue ELSE 0 END) AS DOUBLE) AS premium_revenue,
    max(dbt_loaded_at) AS dbt_loaded_at
FROM fct WHERE order_status = 'completed' GROUP BY order_date, order_year, order_month"""
_GEOGRAPHY = """
SELECT continent, continent_group, region, country_code, country_name, economic_tier,
    count(customer_id) AS total_customers, count(customer_id) FILTER (WHERE total_orders > 0) AS active_customers,
    CAST(sum(total_spent) AS DOUBLE) AS total_revenue,
    CAST(sum(total_spent) AS DOUBLE) / count(*) AS avg_customer_value,
    CAST(sum(total_orders) AS DOUBLE) / count(*) AS avg_orders_per_customer,
    CAST(coalesce(sum(total_spent) FILTER (WHERE customer_tier = 'VIP'), 0) AS DOUBLE) AS vip_revenue,
    count(customer_id) FILTER (WHERE customer_tier = 'VIP') AS vip_customers,
    round(count(customer_id) FILTER (WHERE total_orders > 0) * CAST(100 AS DOUBLE) / count(customer_id), 2)
        AS activation_rate_percent,
    round(count(customer_id) FILTER (WHERE customer_tier = 'VIP') * CAST(100 AS DOUBLE) / count(customer_id), 2)
        AS vip_rate_percent,
    max(dbt_loaded_at) AS dbt_loaded_at
FROM dim_geo GROUP BY continent, continent_group, region, country_code, country_name, economic_tier"""


def _captured(table: str) -> str:
    return _sql(f"SELECT {_CAPTURED[table]} FROM cdc WHERE tab = '{table}'")


def oracle_sql() -> dict[str, str]:
    fct = _doubles(
        "fct", "order_amount", "total_paid_amount", "net_revenue", "paid_amount", "outstanding_amount"
    )
    return {
        "stg_customers": _sql("SELECT * FROM t_customers"),
        "stg_orders": _sql(_STG_ORDERS),
        "stg_payments": _sql(_doubles("t_payments", "payment_amount")),
        "int_customer_orders": _sql(_doubles("customers_active", "total_spent")),
        "int_order_payments": _sql(_doubles("orders_paid", "order_amount", "total_paid_amount")),
        "dim_customers": _sql(_doubles("dim_out", "total_spent")),
        "dim_customers_enriched": _sql(_doubles("dim_geo", "total_spent")),
        "fct_orders": _sql(fct),
        "fct_orders_any_ids": _sql(fct),
        "fct_daily_sales": _sql(_DAILY),
        "fct_payments": _sql(_FCT_PAYMENTS),
        "customer_metrics": _sql(_METRICS),
        "customer_metrics_early": _sql(_METRICS, as_of=EARLY_AS_OF),
        "customer_acquisition": _sql("""
SELECT signup_date, CAST(year(signup_date) AS INTEGER) AS signup_year,
    CAST(month(signup_date) AS INTEGER) AS signup_month, count(customer_id) AS new_customers,
    count(customer_id) FILTER (WHERE total_orders > 0) AS activated_customers,
    CAST(sum(total_orders) AS BIGINT) AS total_orders_from_cohort,
    CAST(sum(total_spent) AS DOUBLE) AS total_revenue_from_cohort,
    CAST(sum(total_spent) AS DOUBLE) / count(*) AS avg_lifetime_value,
    CAST(sum(total_orders) AS DOUBLE) / count(*) AS avg_orders_per_customer,
    round(count(customer_id) FILTER (WHERE total_orders > 0) * CAST(100 AS DOUBLE) / count(customer_id), 2)
        AS activation_rate_percent,
    max(dbt_loaded_at) AS dbt_loaded_at
FROM dim_out GROUP BY signup_date"""),
        "customer_geography": _sql(_GEOGRAPHY),
        "dim_dates": _sql(_DATES),
        "csv_roundtrip": _sql(_DATES),
        "compact_dim_customers": _sql("""
SELECT customer_id, customer_name, email, country_code, total_orders, CAST(total_spent AS DOUBLE) AS total_spent,
    last_order_date, customer_tier AS customer_segment, dbt_loaded_at AS processed_at
FROM dim_out"""),
        "compact_fct_orders": _sql("""
SELECT o.order_id, o.customer_id, d.customer_name, CAST(o.order_amount AS DOUBLE) AS amount,
    o.order_status AS status, o.ordered_at AS order_date, d.country_code, d.customer_tier AS customer_segment,
    as_of AS processed_at
FROM t_orders o CROSS JOIN params LEFT JOIN dim_out d ON d.customer_id = o.customer_id"""),
        "start_date_cutoff": _sql(_STG_ORDERS, start=LATE_START),
        "country_codes_in_use": _sql(
            "SELECT * FROM countries WHERE country_code IN (SELECT country_code FROM t_customers)"
        ),
        "country_lookup_unmatched": _sql(
            "SELECT customer_id, country_code, continent_group, economic_tier FROM dim_geo WHERE country_name IS NULL"
        ),
        "orders_unpaid": _sql("""
SELECT order_id, customer_id, CAST(order_amount AS DOUBLE) AS order_amount, payment_count, distinct_payment_methods
FROM orders_paid WHERE payment_status = 'unpaid'"""),
        "rfm_counts": _sql(
            "SELECT recency_segment, frequency_segment, monetary_segment, count(*) AS customers"
            f" FROM ({_METRICS}) GROUP BY recency_segment, frequency_segment, monetary_segment"
        ),
        "dq_future_orders": _sql(
            _check("future_orders", "SELECT count(*) FROM fct, params WHERE ordered_at > as_of"), as_of=EARLY_AS_OF
        ),
        "dq_revenue_mismatch": _sql(
            _check("revenue_mismatch", _REVENUE_MISMATCHES)
        ),
        "dq_invalid_emails": _sql(_INVALID_EMAILS),
        "dq_invalid_email_rows": _sql(f"SELECT customer_id, email {_INVALID}"),
        "dq_freshness": _sql(_FRESHNESS),
        "dq_row_floors": _sql(_FLOORS),
        "dq_not_null": _sql(_NOT_NULL),
        "dq_unique": _sql(_UNIQUE),
        "dq_referential": _sql(_REFERENCES),
        "dq_non_negative": _sql(_NON_NEGATIVE),
        "dq_defaults": _sql(
            "SELECT id, upper(trim(coalesce(country_code, 'US'))) AS country_code FROM src_customers"
        ),
        "dq_failed_checks": _sql(f"SELECT * FROM ({_ALL_CHECKS}) WHERE violations > 0"),
        "cdc_parse": _sql(f"SELECT {_PARSED}, op FROM cdc"),
        "cdc_flat_parse": _sql(f"SELECT {_PARSED} FROM cdc"),
        "cdc_stream_customers": _captured("customers"),
        "cdc_stream_orders": _captured("orders"),
        "cdc_stream_payments": _captured("payments"),
        "sink_partitioned_roundtrip": _sql("SELECT *, signup_date AS dt FROM t_customers"),
        "sink_sorted_roundtrip": _sql(_STG_ORDERS),
        "sink_stored_marts": _sql("""
SELECT table_name, row_count FROM (
    SELECT 'dim_customers' AS table_name, (SELECT count(*) FROM dim_out) AS row_count
    UNION ALL SELECT 'dim_customers_enriched', (SELECT count(*) FROM dim_geo)
    UNION ALL SELECT 'fct_orders', (SELECT count(*) FROM fct)
    UNION ALL SELECT 'fct_daily_sales', (SELECT count(DISTINCT order_date) FROM fct WHERE order_status = 'completed')
    UNION ALL SELECT 'fct_payments', (SELECT count(*) FROM t_payments p LEFT JOIN fct f ON f.order_id = p.order_id)
    UNION ALL SELECT 'customer_metrics', (SELECT count(*) FROM dim_out)
    UNION ALL SELECT 'customer_acquisition', (SELECT count(DISTINCT signup_date) FROM dim_out)
    UNION ALL SELECT 'customer_geography', (SELECT count(*) FROM (SELECT DISTINCT country_code FROM dim_geo))
    UNION ALL SELECT 'dim_dates', (SELECT max(order_date) - min(order_date) + 1 FROM t_orders)
    UNION ALL SELECT 'compact_dim_customers', (SELECT count(*) FROM dim_out)
    UNION ALL SELECT 'compact_fct_orders', (SELECT count(*) FROM fct))"""),
        "append_twice": _sql(
            "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (TABLE src_orders UNION ALL TABLE src_orders)"
        ),
        "seed_if_empty": _sql("SELECT * FROM src_customers"),
        "preview": _sql(
            "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM src_orders ORDER BY id NULLS LAST LIMIT 5"
        ),
        "cdc_parse_odd_times": _sql("SELECT event_id AS id, CASE WHEN event_id % 4 IN (0, 2) THEN ts END AS created_at FROM events"),
        "cdc_stream_two_runs": _captured("orders"),
        "current_orders": _sql(_doubles("src_orders", "amount"), sources=_CAPTURED_SOURCES),
        "captured_fct_orders": _sql(fct, as_of=CAPTURED_AS_OF, sources=_CAPTURED_SOURCES),
        "captured_orders_of_days": _captured("orders")
        + f" AND ts >= TIMESTAMP '{SOME_DAYS[0]}' AND ts < TIMESTAMP '{SOME_DAYS[1]}'",
        "stored_fct_payments": _sql(_FCT_PAYMENTS),
        "stored_customer_geography": _sql(_GEOGRAPHY),
        "fct_orders_repeated_ids": _sql(fct, sources=_AWKWARD_SOURCES),
        "fct_payments_orphans": _sql(_FCT_PAYMENTS, sources=_AWKWARD_SOURCES),
        "dq_non_negative_violated": _sql(_NON_NEGATIVE, sources=_AWKWARD_SOURCES),
        "dq_not_null_violated": _sql(_NOT_NULL, sources=_AWKWARD_SOURCES),
        "dq_unique_violated": _sql(_UNIQUE, sources=_AWKWARD_SOURCES),
        "dq_referential_violated": _sql(_REFERENCES, sources=_AWKWARD_SOURCES),
        "dq_revenue_mismatch_violated": _sql(
            _check(
                "revenue_mismatch",
                "SELECT count(*) FROM fct WHERE order_status = 'completed'"
                " AND net_revenue + CASE WHEN order_id % 17 = 0 THEN 1 ELSE 0 END <> order_amount",
            )
        ),
        "status_defaults": _sql(
            "SELECT id, customer_id, CAST(amount AS DOUBLE) AS amount, coalesce(status, 'pending') AS status FROM src_orders",
            sources=_AWKWARD_SOURCES,
        ),
        "dim_dates_holidays": _sql(
            _DATES.replace("min(order_date)", f"min(order_date) + {HOLIDAY_SHIFT}").replace(
                "max(order_date)", f"max(order_date) + {HOLIDAY_SHIFT}"
            )
        ),
        "sink_measured_checks": _sql(
            " UNION ALL ".join(
                [
                    _check("future_orders", "SELECT count(*) FROM fct, params WHERE ordered_at > as_of"),
                    _check("revenue_mismatch", _REVENUE_MISMATCHES),
                    _INVALID_EMAILS,
                    _check("row_floor:dim_customers", f"SELECT greatest({ROW_FLOORS['dim_customers']} - count(*), 0) FROM dim_out"),
                    _check("row_floor:fct_orders", f"SELECT greatest({ROW_FLOORS['fct_orders']} - count(*), 0) FROM fct"),
                ]
            ),
            as_of=EARLY_AS_OF,
        ),
        "bucketed_order_payments": _sql(_doubles("orders_paid", "order_amount", "total_paid_amount")),
        "bucketed_fct_payments": _sql(_FCT_PAYMENTS),
        "customer_look_up": _sql(
            _doubles("dim_out", "total_spent")
            + " WHERE customer_id IN (SELECT unnest([min(customer_id), (min(customer_id) + max(customer_id)) // 2, max(customer_id)]) FROM dim_out)"
        ),
        "customer_orders_look_up": _sql(
            f"{fct} WHERE customer_id IN (SELECT unnest([min(customer_id), max(customer_id)]) FROM fct)"
        ),
        "cdc_parse_binary": _sql(f"SELECT {_PARSED}, op FROM cdc"),
        "cdc_redelivered": _captured("orders"),
        "cdc_empty_batch": _captured("orders"),
        "cdc_reject_counts": """
SELECT CASE WHEN event_id % 5 = 0 THEN 'not json' WHEN event_id % 11 = 0 THEN 'unknown operation'
    WHEN event_id % 7 = 0 THEN 'no operation' WHEN event_id % 13 = 0 THEN 'no table' WHEN event_id % 23 = 0 THEN 'no row'
    WHEN event_id % 17 = 0 THEN 'amount' WHEN event_id % 19 = 0 THEN 'time' ELSE 'accepted' END AS reason,
    count(*) AS records
FROM events GROUP BY reason""",
        "cdc_unknown_fields": """
SELECT event_id AS id, 'coupon' AS field, 'c' || event_id AS content FROM events
WHERE event_id % 6 = 0 AND event_id % 5 <> 0 AND event_id % 23 <> 0""",
        "cdc_continuity_gaps": _GAPS,
        "cdc_continuity_stream": _GAPS,
        "captured_compacted": _sql(f"SELECT {_CAPTURED['orders'].replace('ts AS created_at', 'CAST(NULL AS TIMESTAMP) AS created_at')}"
            " FROM cdc, range(2) WHERE tab = 'orders'"),
        "current_after_key_deletes": _sql(_doubles("src_orders", "amount"), sources=_CAPTURED_SOURCES),
        "current_orders_refreshed": _sql(_doubles("src_orders", "amount"), sources=_CAPTURED_SOURCES),
        "current_orders_partly_refreshed": _sql(_doubles("src_orders", "amount"), sources=_CAPTURED_SOURCES),
        "refreshed_fct_orders": _sql(fct, as_of=CAPTURED_AS_OF, sources=_CAPTURED_SOURCES),
        "refreshed_fct_payments": _sql(_FCT_PAYMENTS, as_of=CAPTURED_AS_OF, sources=_CAPTURED_SOURCES),
        "refreshed_fct_daily_sales": _sql(_DAILY, as_of=CAPTURED_AS_OF, sources=_CAPTURED_SOURCES),
        "customers_by_month": _sql(
            "SELECT order_year, order_month, count(DISTINCT customer_id) AS monthly_customers FROM fct"
            " WHERE order_status = 'completed' GROUP BY order_year, order_month"
        ),
        "customers_by_day": _sql(
            "SELECT order_date, count(DISTINCT customer_id) AS daily_customers FROM fct WHERE order_status = 'completed' GROUP BY order_date"
        ),
        "orders_before_now": _sql("SELECT order_id, order_date FROM t_orders"),
        "values_and_view": _sql("""
SELECT CASE order_status WHEN 'completed' THEN 'done' ELSE 'open' END AS label, count(*) AS orders,
    CAST(sum(order_amount) AS DOUBLE) AS amount
FROM t_orders WHERE order_status IN ('completed', 'pending', 'shipped') GROUP BY label"""),
        "table_counts": _sql("""
SELECT 'customers' AS table_name, count(*) AS row_count FROM src_customers
UNION ALL SELECT 'orders', count(*) FROM src_orders"""),
    }
