"""Raw table schemas (column order is load order: CSV binds by position)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DateType()
B = T.BooleanType()
TS = T.TimestampNTZType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


ACCOUNTS = _struct(
    ("account_id", S), ("account_name", S), ("industry", S), ("country", S),
    ("signup_date", D), ("referral_source", S), ("plan_tier", S),
    ("seats", dec(10, 0)), ("is_trial", B), ("churn_flag", B),
)

SUBSCRIPTIONS = _struct(
    ("subscription_id", S), ("account_id", S), ("start_date", D), ("end_date", D),
    ("plan_tier", S), ("seats", dec(10, 0)), ("mrr_amount", dec(12, 2)),
    ("arr_amount", dec(14, 2)), ("is_trial", B), ("upgrade_flag", B),
    ("downgrade_flag", B), ("churn_flag", B), ("billing_frequency", S),
    ("auto_renew_flag", B),
)

SUPPORT_TICKETS = _struct(
    ("ticket_id", S), ("account_id", S), ("submitted_at", TS), ("closed_at", TS),
    ("resolution_time_hours", dec(10, 2)), ("priority", S),
    ("first_response_time_minutes", dec(10, 2)), ("satisfaction_score", dec(3, 1)),
    ("escalation_flag", B),
)

PAYMENTS = _struct(
    ("payment_id", S), ("account_id", S), ("subscription_id", S), ("payment_date", D),
    ("amount", dec(12, 2)), ("currency", S), ("payment_status", S), ("payment_method", S),
)

AI_USAGE_EVENTS = T.StructType([
    T.StructField("raw_event", T.VariantType(), True),
    T.StructField("source_file", S, True),
    T.StructField("ingested_at", TS, True),
])

# Declared lengths of the text columns; a longer value aborts a load.
MAX_LENGTH = {
    "accounts": {"account_id": 50, "account_name": 255, "industry": 150, "country": 100, "referral_source": 100,
                 "plan_tier": 50},
    "subscriptions": {"subscription_id": 50, "account_id": 50, "plan_tier": 50, "billing_frequency": 30},
    "support_tickets": {"ticket_id": 50, "account_id": 50, "priority": 30},
    "payments": {"payment_id": 50, "account_id": 50, "subscription_id": 50, "currency": 10, "payment_status": 30,
                 "payment_method": 50},
}

CSV_TABLES = {
    "accounts": ACCOUNTS,
    "subscriptions": SUBSCRIPTIONS,
    "payments": PAYMENTS,
    "support_tickets": SUPPORT_TICKETS,
}

# Landing prefixes per source, relative to the landing root
# (CSV sources are partitioned by ingestion_date=, events by year=/month=).
LANDING_PREFIX = {
    "accounts": "postgres/accounts",
    "subscriptions": "postgres/subscriptions",
    "payments": "external/payments",
    "support_tickets": "external/support_tickets",
    "ai_usage_events": "events/ai_usage",
}

# Markers the CSV format reads as NULL (besides an empty field).
CSV_NULL_MARKERS = ("NULL", "null", "")

# The declared vocabularies.
PLAN_TIERS = ("Starter", "Professional", "Business", "Enterprise")
BILLING_FREQUENCIES = ("Monthly", "Annual")
CURRENCIES = ("USD",)
PAYMENT_STATUSES = ("Succeeded", "Failed")
PAYMENT_METHODS = ("ACH", "Credit Card", "Wire Transfer")
PRIORITIES = ("P1 - Critical", "P2 - High", "P3 - Medium", "P4 - Low")
EVENT_STATUSES = ("SUCCESS", "FAILED", "ERROR", "TIMEOUT")
BOOLEAN_VALUES = (True, False)
