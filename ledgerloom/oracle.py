"""Independent DuckDB SQL for every registered query (the cross-engine check).

Written by another route than the Spark models, so that a slip in one does not
repeat in the other: measures are rows (owner, name, value), summed and looked
up in one map an owner; payments of a subscription come from windows; outcomes
from a lookup table. The driver registers the parquet tables as views; each
statement re-derives the raw tables from them (same mapping as
``sources.driver_tables``) and then computes the model. Decimals are cast to
DOUBLE and averages rounded to six digits at the very end, for the comparison
only (the Spark side does the same in ``registry.comparable``).
"""

from __future__ import annotations

FIXTURE_SOURCE_FILE = "events/ai_usage/year=2026/month=09/ai_usage_events.json"
FIXTURE_INGESTED_AT = "2026-10-02 00:00:00"
FIXTURE_AS_OF = "2026-10-02"


def _avg(expr: str) -> str:
    return f"ROUND(CAST(AVG({expr}) AS DECIMAL(28,12)), 6)"


# Columns read from an owner's map of summed measures ("f").
def _sum(m: str) -> str:
    return f"COALESCE(f['{m}'], 0)"


def _count(m: str) -> str:
    return f"CAST(COALESCE(f['{m}'], 0) AS BIGINT)"


def _mean(total: str, n: str) -> str:
    return (f"COALESCE(ROUND(CAST(CAST(f['{total}'] AS DOUBLE) / NULLIF(CAST(f['{n}'] AS DOUBLE), 0) "
            f"AS DECIMAL(28,12)), 6), 0)")


def _tier(k: str) -> str:
    return (f"CASE {k} % 4 WHEN 0 THEN 'Starter' WHEN 1 THEN 'Professional' "
            f"WHEN 2 THEN 'Business' ELSE 'Enterprise' END")


RAW_CTES = f"""
owners AS (
    SELECT concat('A-', c_custkey) AS account_id, c_custkey AS k, c_name AS name, c_nationkey AS nation,
           c_acctbal AS balance, c_mktsegment AS industry FROM customer
    UNION ALL
    SELECT concat('V-', s_suppkey), s_suppkey, s_name, s_nationkey, s_acctbal, 'PARTNER' FROM supplier
),
accounts AS (
    SELECT account_id, name AS account_name, industry, n_name AS country,
           CAST(DATE '1995-01-01' + CAST(k % 1500 AS INTEGER) AS DATE) AS signup_date,
           CASE k % 3 WHEN 0 THEN 'Organic' WHEN 1 THEN 'Partner' ELSE 'Ads' END AS referral_source,
           {_tier('k')} AS plan_tier,
           CAST(k % 50 + 1 AS DECIMAL(10,0)) AS seats,
           k % 7 = 0 AS is_trial,
           balance < 0 AS churn_flag
    FROM owners JOIN nation ON nation = n_nationkey
),
subscriptions AS (
    SELECT concat('S-', o_orderkey) AS subscription_id, concat('A-', o_custkey) AS account_id,
           CAST(o_orderdate AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date,
           {_tier('o_orderkey')} AS plan_tier,
           CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_orderkey % 25 + 1 AS DECIMAL(10,0)) END AS seats,
           CAST(o_totalprice AS DECIMAL(12,2)) AS mrr_amount,
           CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 12 AS DECIMAL(14,2)) AS arr_amount,
           o_orderpriority = '5-LOW' AS is_trial,
           o_orderpriority = '1-URGENT' AS upgrade_flag,
           o_orderpriority = '4-NOT SPECIFIED' AS downgrade_flag,
           o_orderstatus = 'F' AS churn_flag,
           CASE WHEN o_orderkey % 2 = 0 THEN 'Monthly' ELSE 'Annual' END AS billing_frequency,
           o_orderstatus = 'O' AS auto_renew_flag
    FROM orders
),
payments AS (
    SELECT concat('P-', l_orderkey, '-', l_partkey, '-', l_suppkey, '-', l_linenumber, '-',
                  CAST(l_shipdate AS DATE)) AS payment_id,
           concat('A-', o_custkey) AS account_id, concat('S-', l_orderkey) AS subscription_id,
           CAST(l_shipdate AS DATE) AS payment_date,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, 'USD' AS currency,
           CASE WHEN l_returnflag = 'R' THEN 'Failed' ELSE 'Succeeded' END AS payment_status,
           CASE l_suppkey % 3 WHEN 0 THEN 'ACH' WHEN 1 THEN 'Credit Card' ELSE 'Wire Transfer' END AS payment_method
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
support_tickets AS (
    SELECT concat('T-', event_id) AS ticket_id, concat('A-', user_id) AS account_id,
           ts AS submitted_at,
           CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts + INTERVAL 6 HOUR END AS closed_at,
           CAST(value AS DECIMAL(10,2)) AS resolution_time_hours,
           CASE event_type WHEN 'error' THEN 'P1 - Critical' WHEN 'signup' THEN 'P2 - High'
                WHEN 'purchase' THEN 'P3 - Medium' ELSE 'P4 - Low' END AS priority,
           CAST(event_id % 120 AS DECIMAL(10,2)) AS first_response_time_minutes,
           CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 5 + 1 AS DECIMAL(3,1)) END AS satisfaction_score,
           event_type = 'error' AS escalation_flag
    FROM events
),
event_fields AS (
    SELECT concat('E-', event_id) AS event_id,
           CASE WHEN event_id % 3 = 0 THEN concat(' A-', user_id, ' ') ELSE concat('A-', user_id) END AS account_id,
           concat('S-', event_id % (SELECT count(*) FROM orders)) AS subscription_id,
           CAST(substr(CAST(ts AS VARCHAR), 1, 19) AS TIMESTAMP) AS event_timestamp,
           CASE WHEN event_id % 50 = 0 THEN NULL ELSE concat('model-', event_id % 3) END AS model_name,
           concat('feature-', event_id % 4) AS feature_name,
           CAST(event_id % 400 AS BIGINT) AS input_tokens,
           CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 300 END AS BIGINT) AS output_tokens,
           CAST(event_id % 2000 AS BIGINT) AS latency_ms,
           CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'timeout'
                WHEN 'click' THEN ' Success ' WHEN 'view' THEN 'error'
                WHEN 'purchase' THEN 'success' END AS status
    FROM events
)"""

MODEL_CTES = f"""
stg_accounts AS (SELECT * FROM accounts),
stg_subscriptions AS (SELECT * FROM subscriptions),
stg_payments AS (SELECT * FROM payments),
stg_support_tickets AS (SELECT * FROM support_tickets),
stg_ai_usage_events AS (
    SELECT event_id, account_id, subscription_id, event_timestamp, model_name, feature_name,
           input_tokens, output_tokens,
           COALESCE(input_tokens, 0) + COALESCE(output_tokens, 0) AS total_tokens,
           latency_ms, status, CAST(NULL AS VARCHAR) AS error_type,
           '{FIXTURE_SOURCE_FILE}' AS source_file,
           TIMESTAMP '{FIXTURE_INGESTED_AT}' AS ingested_at
    FROM event_fields
),
ai_usage_events AS (
    SELECT json_object('event_id', event_id, 'account_id', account_id) AS raw_event,
           source_file, ingested_at
    FROM stg_ai_usage_events
),
-- every measure as a row (owner, name, value), summed, and kept as one map an owner
account_measures AS (
    SELECT account_id, unnest(['subs', 'live', 'seats', 'mrr', 'arr', 'up', 'down', 'gone', 'renew']) AS m,
           unnest(CAST([1, CAST(NOT churn_flag AS INTEGER), COALESCE(seats, 0), mrr_amount, arr_amount,
                        CAST(upgrade_flag AS INTEGER), CAST(downgrade_flag AS INTEGER), CAST(churn_flag AS INTEGER),
                        CAST(auto_renew_flag AS INTEGER)] AS DECIMAL(18,2)[])) AS v
    FROM subscriptions
    UNION ALL
    SELECT account_id, concat('n_', payment_status), 1 FROM payments
    UNION ALL
    SELECT account_id, concat('sum_', payment_status), amount FROM payments
    UNION ALL
    SELECT account_id, unnest(['tickets', 'escalated', 'hours', 'n_hours', 'minutes', 'n_minutes', 'stars', 'n_stars']),
           unnest(CAST([1, CAST(escalation_flag AS INTEGER), resolution_time_hours,
                        CAST(resolution_time_hours IS NOT NULL AS INTEGER), first_response_time_minutes,
                        CAST(first_response_time_minutes IS NOT NULL AS INTEGER), satisfaction_score,
                        CAST(satisfaction_score IS NOT NULL AS INTEGER)] AS DECIMAL(18,2)[]))
    FROM support_tickets
),
account_totals AS (
    SELECT account_id, m, COALESCE(SUM(v), 0) AS v FROM account_measures GROUP BY account_id, m
),
account_map AS (
    SELECT account_id, map_from_entries(list((m, v))) AS f FROM account_totals GROUP BY account_id
),
account_days AS (
    SELECT account_id, MIN(d) FILTER (WHERE kind = 'start') AS first_start, MAX(d) FILTER (WHERE kind = 'start') AS last_start,
           MIN(d) FILTER (WHERE kind = 'Succeeded') AS first_paid, MAX(d) FILTER (WHERE kind = 'Succeeded') AS last_paid
    FROM (SELECT account_id, 'start' AS kind, start_date AS d FROM subscriptions
          UNION ALL SELECT account_id, payment_status, payment_date FROM payments)
    GROUP BY account_id
),
owner AS (
    SELECT * EXCLUDE (seats) FROM accounts
),
int_account_revenue AS (
    SELECT owner.*,
           {_count('subs')} AS subscription_count, {_count('live')} AS active_subscription_count,
           {_sum('seats')} AS total_seats, {_sum('mrr')} AS mrr_amount, {_sum('arr')} AS arr_amount,
           first_start AS first_subscription_date, last_start AS latest_subscription_date,
           {_count('up')} AS upgrade_count, {_count('down')} AS downgrade_count,
           {_count('gone')} AS churned_subscription_count, {_count('renew')} AS auto_renew_subscription_count,
           {_count('n_Succeeded')} + {_count('n_Failed')} AS payment_count,
           {_count('n_Succeeded')} AS successful_payment_count, {_count('n_Failed')} AS failed_payment_count,
           {_sum('sum_Succeeded')} AS total_revenue, {_sum('sum_Failed')} AS failed_payment_amount,
           first_paid AS first_payment_date, last_paid AS last_payment_date,
           {_mean('sum_Succeeded', 'n_Succeeded')} AS average_payment_amount
    FROM owner LEFT JOIN account_map USING (account_id) LEFT JOIN account_days USING (account_id)
),
int_customer_360 AS (
    SELECT owner.*,
           {_count('subs')} AS subscription_count,
           {_sum('mrr')} AS total_mrr, {_sum('arr')} AS total_arr, {_sum('seats')} AS total_seats,
           last_start AS latest_subscription_start_date,
           {_count('up')} AS upgrade_count, {_count('down')} AS downgrade_count,
           {_count('gone')} AS churned_subscription_count,
           {_count('n_Succeeded')} + {_count('n_Failed')} AS payment_count,
           {_count('n_Succeeded')} AS successful_payment_count, {_count('n_Failed')} AS failed_payment_count,
           {_sum('sum_Succeeded')} AS total_revenue,
           {_count('tickets')} AS total_support_tickets, {_count('escalated')} AS escalated_ticket_count,
           {_mean('hours', 'n_hours')} AS avg_resolution_time_hours,
           {_mean('minutes', 'n_minutes')} AS avg_first_response_time_minutes,
           {_mean('stars', 'n_stars')} AS avg_satisfaction_score
    FROM owner LEFT JOIN account_map USING (account_id) LEFT JOIN account_days USING (account_id)
),
-- payments of each subscription by a running total over its rows, the last row kept
paid AS (
    SELECT subscription_id, n, n_ok, total, latest FROM (
        SELECT subscription_id, COUNT(*) OVER w AS n, MAX(payment_date) OVER w AS latest,
               SUM(CAST(payment_status = 'Succeeded' AS INTEGER)) OVER w AS n_ok,
               SUM(amount * CAST(payment_status = 'Succeeded' AS INTEGER)) OVER w AS total,
               ROW_NUMBER() OVER (PARTITION BY subscription_id ORDER BY payment_id DESC) AS back
        FROM payments WINDOW w AS (PARTITION BY subscription_id))
    WHERE back = 1
),
int_subscription_metrics AS (
    SELECT x.* EXCLUDE (end_date),
           CAST(DATE '{FIXTURE_AS_OF}' - x.start_date AS BIGINT) AS subscription_age_days,
           COALESCE(n, 0) AS payment_count, CAST(COALESCE(n_ok, 0) AS BIGINT) AS successful_payment_count,
           CAST(COALESCE(n - n_ok, 0) AS BIGINT) AS failed_payment_count,
           COALESCE(total, 0) AS total_payment_amount, latest AS last_payment_date,
           {_count('tickets')} AS support_ticket_count,
           {_mean('hours', 'n_hours')} AS avg_resolution_time_hours,
           {_mean('minutes', 'n_minutes')} AS avg_first_response_time_minutes,
           {_mean('stars', 'n_stars')} AS avg_satisfaction_score,
           {_count('escalated')} AS escalated_ticket_count
    FROM subscriptions x LEFT JOIN paid USING (subscription_id) LEFT JOIN account_map USING (account_id)
),
-- outcomes by lookup, not by comparing texts in place
outcome(status, is_success, is_failure) AS (
    VALUES ('SUCCESS', 1, 0), ('FAILED', 0, 1), ('ERROR', 0, 1), ('TIMEOUT', 0, 1)
),
int_ai_usage_metrics AS (
    SELECT event_id, regexp_replace(account_id, '^ +| +$', '', 'g') AS account_id,
           regexp_replace(subscription_id, '^ +| +$', '', 'g') AS subscription_id,
           event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
           CAST(make_date(year(event_timestamp), month(event_timestamp), 1) AS TIMESTAMP) AS event_month,
           model_name, feature_name, input_tokens, output_tokens, total_tokens, latency_ms,
           shown AS status, error_type, COALESCE(is_success, 0) AS is_success, COALESCE(is_failure, 0) AS is_failure,
           -- exact half-up rounding of latency / tokens to 6 digits, in integers
           CASE WHEN total_tokens > 0
                THEN CAST((latency_ms * 2000000 + total_tokens) // (2 * total_tokens) AS DOUBLE) / 1000000
                ELSE 0 END AS latency_per_token,
           source_file, ingested_at
    FROM (SELECT *, upper(regexp_replace(status, '^ +| +$', '', 'g')) AS shown FROM stg_ai_usage_events) e
    LEFT JOIN outcome ON outcome.status = e.shown
),
dim_customer AS (
    SELECT account_id AS customer_key, * EXCLUDE (seats) FROM accounts
),
dim_subscription AS (
    SELECT subscription_id AS subscription_key, * EXCLUDE (account_id, end_date), account_id AS customer_key FROM subscriptions
),
dim_ai_model AS (
    SELECT concat('model-', r) AS ai_model_key, ai_model_key AS model_name
    FROM (SELECT event_id % 3 AS r FROM events WHERE event_id % 50 <> 0 GROUP BY r)
),
dim_feature AS (
    SELECT concat('feature-', r) AS feature_key, feature_key AS feature_name
    FROM (SELECT event_id % 4 AS r FROM events GROUP BY r)
),
fact_ai_usage AS (
    SELECT event_id AS ai_usage_key, account_id AS customer_key, subscription_id AS subscription_key,
           CAST(event_timestamp AS DATE) AS date_key, model_name AS ai_model_key, feature_name AS feature_key,
           CAST(status = 'success' AS INTEGER) AS success_flag, 1 - CAST(status = 'success' AS INTEGER) AS failure_flag,
           * EXCLUDE (account_id, subscription_id, event_timestamp, model_name, feature_name)
    FROM stg_ai_usage_events
),
fact_payments AS (
    SELECT payment_id AS payment_key, * EXCLUDE (account_id, subscription_id, payment_date),
           account_id AS customer_key, subscription_id AS subscription_key, payment_date AS date_key,
           CAST(payment_status = 'Succeeded' AS INTEGER) AS successful_payment_flag,
           CAST(payment_status = 'Failed' AS INTEGER) AS failed_payment_flag
    FROM payments
),
fact_support_tickets AS (
    SELECT ticket_id AS support_ticket_key, * EXCLUDE (account_id), account_id AS customer_key,
           CAST(submitted_at AS DATE) AS submitted_date_key, CAST(closed_at AS DATE) AS closed_date_key,
           1 - CAST(closed_at IS NULL AS INTEGER) AS resolved_flag, CAST(escalation_flag AS INTEGER) AS escalation_count
    FROM support_tickets
),
dim_date AS (
    WITH keys AS (
        SELECT date_key AS d FROM fact_ai_usage
        UNION ALL SELECT date_key FROM fact_payments
        UNION ALL SELECT submitted_date_key FROM fact_support_tickets
        UNION ALL SELECT closed_date_key FROM fact_support_tickets
    ), b AS (SELECT MIN(d) AS lo, MAX(d) AS hi FROM keys), days AS (
        SELECT CAST(g.gs AS DATE) AS date_key
        FROM b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(gs)
        WHERE b.lo IS NOT NULL
    )
    SELECT date_key, CAST(year(date_key) AS BIGINT) AS year, CAST(quarter(date_key) AS BIGINT) AS quarter,
           CAST(month(date_key) AS BIGINT) AS month, CAST(day(date_key) AS BIGINT) AS day_of_month,
           CAST(isodow(date_key) AS BIGINT) AS iso_day_of_week, CAST(weekofyear(date_key) AS BIGINT) AS iso_week,
           dayname(date_key) AS day_name, monthname(date_key) AS month_name,
           isodow(date_key) >= 6 AS is_weekend
    FROM days
)"""

ALL_CTES = RAW_CTES + "," + MODEL_CTES

# Decimal-typed output columns per model (cast to DOUBLE for the comparison).
DECIMAL_COLUMNS = {
    "accounts": ["seats"],
    "subscriptions": ["seats", "mrr_amount", "arr_amount"],
    "payments": ["amount"],
    "support_tickets": ["resolution_time_hours", "first_response_time_minutes", "satisfaction_score"],
    "stg_accounts": ["seats"],
    "stg_subscriptions": ["seats", "mrr_amount", "arr_amount"],
    "stg_payments": ["amount"],
    "stg_support_tickets": ["resolution_time_hours", "first_response_time_minutes", "satisfaction_score"],
    "stg_ai_usage_events": [],
    "int_account_revenue": ["total_seats", "mrr_amount", "arr_amount", "total_revenue",
                            "failed_payment_amount", "average_payment_amount"],
    "int_subscription_metrics": ["seats", "mrr_amount", "arr_amount", "total_payment_amount",
                                 "avg_resolution_time_hours", "avg_first_response_time_minutes",
                                 "avg_satisfaction_score"],
    "int_customer_360": ["total_mrr", "total_arr", "total_seats", "total_revenue",
                         "avg_resolution_time_hours", "avg_first_response_time_minutes",
                         "avg_satisfaction_score"],
    "int_ai_usage_metrics": ["latency_per_token"],
    "dim_customer": [],
    "dim_subscription": ["seats", "mrr_amount", "arr_amount"],
    "dim_ai_model": [],
    "dim_feature": [],
    "fact_ai_usage": [],
    "fact_payments": ["amount"],
    "fact_support_tickets": ["resolution_time_hours", "first_response_time_minutes", "satisfaction_score"],
    "dim_date": [],
}


def with_models(select_sql: str) -> str:
    return f"WITH {ALL_CTES}\n{select_sql}"


def model_select(name: str) -> str:
    """``SELECT *`` from a model CTE, decimals as DOUBLE, integers as BIGINT."""
    dec = DECIMAL_COLUMNS.get(name, [])
    if dec:
        rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in dec)
        return with_models(f"SELECT * REPLACE ({rep}) FROM {name}")
    return with_models(f"SELECT * FROM {name}")


def _sql_literal(v) -> str:
    if isinstance(v, bool):
        return f"'{str(v).lower()}'"
    return "'" + str(v).replace("'", "''") + "'"


def check_failures_sql(check) -> str:
    """Failing-row count of one declared check, as a scalar subquery."""
    m, c = check.model, check.column
    if check.test == "not_null":
        return f"(SELECT count(*) FROM {m} WHERE {c} IS NULL)"
    if check.test == "unique":
        return (f"(SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1))")
    if check.test == "accepted_values":
        vals = ", ".join(_sql_literal(v) for v in check.arg)
        col = f"lower(CAST({c} AS VARCHAR))" if isinstance(check.arg[0], bool) else c
        return (f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM {m} "
                f"WHERE {c} IS NOT NULL AND {col} NOT IN ({vals})))")
    if check.test == "relationships":
        to, field = check.arg
        return (f"(SELECT count(*) FROM {m} ch WHERE ch.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {to} pa WHERE pa.{field} = ch.{c}))")
    if check.test == "expression_is_true":
        return f"(SELECT count(*) FROM {m} WHERE NOT ({c} {check.arg}))"
    raise ValueError(check.test)


def checks_sql(checks, with_status: bool = False) -> str:
    rows = []
    for ch in checks:
        f = check_failures_sql(ch)
        status = f", CASE WHEN {f} = 0 THEN 'pass' ELSE 'fail' END AS status" if with_status else ""
        rows.append(f"SELECT '{ch.check_id}' AS check_id, '{ch.layer}' AS layer, '{ch.model}' AS model, "
                    f"'{ch.column}' AS column_name, '{ch.test}' AS test, "
                    f"CAST({f} AS BIGINT) AS failures{status}")
    return with_models("\nUNION ALL\n".join(rows))


def _ratio(num: str, den: str) -> str:
    """Exact half-up num/den at 6 digits (non-negative integers), as DOUBLE."""
    return (f"CASE WHEN COALESCE({den}, 0) = 0 THEN NULL ELSE "
            f"CAST((({num}) * 2000000 + ({den})) // (2 * ({den})) AS DOUBLE) / 1000000 END")


_PREVIEW = """
    SELECT event_id, account_id, model_name AS model, feature_name AS feature, input_tokens,
           output_tokens, latency_ms, status
    FROM stg_ai_usage_events ORDER BY event_id LIMIT 5"""

_PREVIEW_ALT = """
    SELECT event_id, account_id, event_timestamp, CAST(NULL AS VARCHAR) AS model_name,
           CAST(NULL AS VARCHAR) AS feature_name, CAST(NULL AS BIGINT) AS tokens_used,
           CAST(NULL AS DOUBLE) AS cost
    FROM stg_ai_usage_events ORDER BY event_id LIMIT 10"""

EXTRA_SQL = {
    "metric_mrr_arr": with_models("""
        SELECT customer_key, COUNT(*) AS subscription_count,
               CAST(SUM(mrr_amount) AS DOUBLE) AS total_mrr, CAST(SUM(arr_amount) AS DOUBLE) AS total_arr
        FROM dim_subscription GROUP BY customer_key"""),
    "metric_payment_rates": with_models(f"""
        SELECT account_id, payment_count, successful_payment_count, failed_payment_count,
               {_ratio('successful_payment_count', 'payment_count')} AS payment_success_rate,
               {_ratio('failed_payment_count', 'payment_count')} AS payment_failure_rate
        FROM int_account_revenue"""),
    "metric_churn_pressure": with_models(f"""
        SELECT plan_tier, COUNT(*) AS subscription_count,
               COUNT(*) FILTER (WHERE churn_flag = TRUE) AS churned_count,
               COUNT(*) FILTER (WHERE downgrade_flag = TRUE) AS downgraded_count,
               COUNT(*) FILTER (WHERE upgrade_flag = TRUE) AS upgraded_count,
               {_ratio('COUNT(*) FILTER (WHERE churn_flag = TRUE)', 'COUNT(*)')} AS churn_rate,
               {_ratio('COUNT(*) FILTER (WHERE downgrade_flag = TRUE)', 'COUNT(*)')} AS downgrade_rate
        FROM dim_subscription GROUP BY plan_tier"""),
    "metric_support_burden": with_models(f"""
        SELECT account_id, plan_tier, subscription_count, total_support_tickets, escalated_ticket_count,
               CAST(avg_resolution_time_hours AS DOUBLE) AS avg_resolution_time_hours,
               CAST(avg_first_response_time_minutes AS DOUBLE) AS avg_first_response_time_minutes,
               CAST(avg_satisfaction_score AS DOUBLE) AS avg_satisfaction_score,
               {_ratio('escalated_ticket_count', 'total_support_tickets')} AS escalation_rate,
               {_ratio('total_support_tickets', 'subscription_count')} AS tickets_per_subscription
        FROM int_customer_360"""),
    "metric_ai_reliability": with_models(f"""
        SELECT ai_model_key, feature_key, COUNT(*) AS event_count, SUM(total_tokens) AS total_tokens,
               CAST({_avg('latency_ms')} AS DOUBLE) AS avg_latency_ms,
               {_ratio('SUM(success_flag)', 'COUNT(*)')} AS success_rate,
               {_ratio('SUM(failure_flag)', 'COUNT(*)')} AS failure_rate
        FROM fact_ai_usage GROUP BY ai_model_key, feature_key"""),
    "preview_events": with_models(_PREVIEW),
    "preview_events_alt": with_models(_PREVIEW_ALT),
    "load_csv": model_select("payments"),
    "load_accounts": model_select("accounts"),
    "load_csv_line_breaks": with_models("""
        SELECT * REPLACE (account_name || chr(10) || 'of ' || coalesce(country, 'nowhere') AS account_name) FROM accounts"""),
    "load_subscriptions": model_select("subscriptions"),
    "load_support_tickets": model_select("support_tickets"),
    "stage_listing": """
        SELECT source, concat(prefix, '/ingestion_date=2026-10-02') AS folder, TRUE AS has_files, TRUE AS has_bytes
        FROM (SELECT 'accounts' AS source, 'postgres/accounts' AS prefix WHERE EXISTS (SELECT 1 FROM customer)
              UNION ALL SELECT 'subscriptions', 'postgres/subscriptions' WHERE EXISTS (SELECT 1 FROM orders)
              UNION ALL SELECT 'payments', 'external/payments' WHERE EXISTS (SELECT 1 FROM lineitem)
              UNION ALL SELECT 'support_tickets', 'external/support_tickets' WHERE EXISTS (SELECT 1 FROM events))
        UNION ALL
        SELECT DISTINCT 'ai_usage_events', strftime(ts, 'events/ai_usage/year=%Y/month=%m'), TRUE, TRUE FROM events""",
    "incremental_load": model_select("support_tickets"),
    "landing_roundtrip": with_models("""
        SELECT 'accounts' AS source, COUNT(*) AS "rows", COUNT(DISTINCT account_id) AS distinct_ids FROM accounts
        UNION ALL SELECT 'subscriptions', COUNT(*), COUNT(DISTINCT subscription_id) FROM subscriptions
        UNION ALL SELECT 'payments', COUNT(*), COUNT(DISTINCT payment_id) FROM payments
        UNION ALL SELECT 'support_tickets', COUNT(*), COUNT(DISTINCT ticket_id) FROM support_tickets
        UNION ALL SELECT 'ai_usage_events', COUNT(*), COUNT(DISTINCT event_id) FROM stg_ai_usage_events"""),
    "load_ledger": """
        SELECT source, n AS table_rows, n AS ledger_rows, CAST(1 AS BIGINT) AS loads
        FROM (SELECT 'accounts' AS source, (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM supplier) AS n
              UNION ALL SELECT 'subscriptions', (SELECT COUNT(*) FROM orders)
              UNION ALL SELECT 'payments', (SELECT COUNT(*) FROM lineitem)
              UNION ALL SELECT 'support_tickets', (SELECT COUNT(*) FROM events)
              UNION ALL SELECT 'ai_usage_events', (SELECT COUNT(*) FROM events))""",
    "source_presence": """
        SELECT 'accounts' AS source, 'postgres/accounts' AS prefix, EXISTS (SELECT 1 FROM customer) AS present
        UNION ALL SELECT 'subscriptions', 'postgres/subscriptions', EXISTS (SELECT 1 FROM orders)
        UNION ALL SELECT 'payments', 'external/payments', EXISTS (SELECT 1 FROM lineitem)
        UNION ALL SELECT 'support_tickets', 'external/support_tickets', EXISTS (SELECT 1 FROM events)
        UNION ALL SELECT 'ai_usage_events', 'events/ai_usage', EXISTS (SELECT 1 FROM events)
        UNION ALL
        SELECT 'ai_usage_events', printf('events/ai_usage/year=%04d/month=%02d', y, m),
               EXISTS (SELECT 1 FROM events WHERE year(ts) = y AND month(ts) = m)
        FROM (SELECT unnest(generate_series(MIN(year(ts)), MAX(year(ts)))) AS y FROM events),
             (SELECT unnest(generate_series(1, 12)) AS m)""",
}

# relation → layer for the pipeline summary
PIPELINE_RELATIONS = [
    ("raw", "accounts"), ("raw", "subscriptions"), ("raw", "payments"), ("raw", "support_tickets"),
    ("raw", "ai_usage_events"),
    ("staging", "stg_accounts"), ("staging", "stg_subscriptions"), ("staging", "stg_payments"),
    ("staging", "stg_support_tickets"), ("staging", "stg_ai_usage_events"),
    ("intermediate", "int_account_revenue"), ("intermediate", "int_subscription_metrics"),
    ("intermediate", "int_customer_360"), ("intermediate", "int_ai_usage_metrics"),
    ("marts", "dim_customer"), ("marts", "dim_subscription"), ("marts", "dim_ai_model"),
    ("marts", "dim_feature"), ("marts", "fact_ai_usage"), ("marts", "fact_payments"),
    ("marts", "fact_support_tickets"), ("marts", "dim_date"),
]


def pipeline_summary_sql(checks) -> str:
    rows = [f"SELECT '{layer}' AS layer, '{name}' AS table_name, (SELECT COUNT(*) FROM {name}) AS \"rows\""
            for layer, name in PIPELINE_RELATIONS]
    failing = " + ".join(f"CASE WHEN {check_failures_sql(c)} > 0 THEN 1 ELSE 0 END" for c in checks)
    rows.append(f"SELECT 'tests', 'failing_checks', CAST({failing} AS BIGINT)")
    return with_models("\nUNION ALL\n".join(rows))
