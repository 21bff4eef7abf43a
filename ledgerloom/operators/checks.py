"""The declared data tests, as records.

Fixed values: every test the reference declares on its sources, intermediate
views and marts, in declaration order (153 in total: 63 source, 51
intermediate, 39 marts). Column names are lower-cased (resolution is
case-insensitive); the marts declare ``fct_*`` names for the ``fact_*``
models, which are resolved here.
"""

from __future__ import annotations

from dataclasses import dataclass

from ledgerloom.schemas import (BILLING_FREQUENCIES, BOOLEAN_VALUES, CURRENCIES, EVENT_STATUSES,
                                PAYMENT_METHODS, PAYMENT_STATUSES, PLAN_TIERS, PRIORITIES)

NN = ("not_null", None)
UQ = ("unique", None)
GE0 = ("expression_is_true", ">= 0")


def AV(values):
    return ("accepted_values", tuple(values))


def REL(to, field):
    return ("relationships", (to, field))


BOOL = AV(BOOLEAN_VALUES)

# layer → model → column → tests
DECLARED = {
    "source": {
        "accounts": {
            "account_id": [NN, UQ],
            "account_name": [NN],
            "industry": [NN],
            "country": [NN],
            "signup_date": [NN],
            "referral_source": [NN],
            "plan_tier": [NN, AV(PLAN_TIERS)],
            "is_trial": [NN],
            "churn_flag": [NN],
        },
        "subscriptions": {
            "subscription_id": [NN, UQ],
            "account_id": [NN, REL("accounts", "account_id")],
            "start_date": [NN],
            "plan_tier": [NN, AV(PLAN_TIERS)],
            "seats": [NN],
            "mrr_amount": [NN],
            "arr_amount": [NN],
            "is_trial": [NN, BOOL],
            "upgrade_flag": [NN, BOOL],
            "downgrade_flag": [NN, BOOL],
            "churn_flag": [NN, BOOL],
            "billing_frequency": [NN, AV(BILLING_FREQUENCIES)],
            "auto_renew_flag": [NN, BOOL],
        },
        "payments": {
            "payment_id": [NN, UQ],
            "account_id": [NN, REL("accounts", "account_id")],
            "subscription_id": [NN, REL("subscriptions", "subscription_id")],
            "payment_date": [NN],
            "amount": [NN],
            "currency": [NN, AV(CURRENCIES)],
            "payment_status": [NN, AV(PAYMENT_STATUSES)],
            "payment_method": [NN, AV(PAYMENT_METHODS)],
        },
        "support_tickets": {
            "ticket_id": [NN, UQ],
            "account_id": [NN, REL("accounts", "account_id")],
            "submitted_at": [NN],
            "closed_at": [NN],
            "resolution_time_hours": [NN],
            "priority": [NN, AV(PRIORITIES)],
            "first_response_time_minutes": [NN],
            "satisfaction_score": [NN],
            "escalation_flag": [NN, BOOL],
        },
        "ai_usage_events": {
            "raw_event": [NN],
            "source_file": [NN],
            "ingested_at": [NN],
        },
    },
    "intermediate": {
        "int_account_revenue": {
            "account_id": [NN, UQ, REL("stg_accounts", "account_id")],
            "subscription_count": [NN],
            "active_subscription_count": [NN],
            "mrr_amount": [NN],
            "arr_amount": [NN],
            "total_revenue": [NN],
            "payment_count": [NN],
            "successful_payment_count": [NN],
            "failed_payment_count": [NN],
            "plan_tier": [AV(PLAN_TIERS)],
        },
        "int_ai_usage_metrics": {
            "event_id": [NN, UQ],
            "account_id": [NN],
            "subscription_id": [NN],
            "model_name": [NN],
            "feature_name": [NN],
            "input_tokens": [NN, GE0],
            "output_tokens": [NN, GE0],
            "total_tokens": [NN, GE0],
            "latency_ms": [NN, GE0],
            "status": [NN, AV(EVENT_STATUSES)],
            "event_date": [NN],
        },
        "int_customer_360": {
            "account_id": [NN, UQ, REL("stg_accounts", "account_id")],
            "subscription_count": [NN, GE0],
            "total_revenue": [NN, GE0],
            "total_support_tickets": [NN, GE0],
        },
        "int_subscription_metrics": {
            "subscription_id": [NN, UQ, REL("stg_subscriptions", "subscription_id")],
            "account_id": [NN, REL("stg_accounts", "account_id")],
            "payment_count": [NN, GE0],
            "total_payment_amount": [NN, GE0],
            "support_ticket_count": [NN, GE0],
            "billing_frequency": [NN, AV(BILLING_FREQUENCIES)],
        },
    },
    "marts": {
        "dim_customer": {
            "customer_key": [UQ, NN],
        },
        "dim_subscription": {
            "subscription_key": [UQ, NN],
            "customer_key": [NN, REL("dim_customer", "customer_key")],
        },
        "dim_date": {
            "date_key": [UQ, NN],
        },
        "dim_ai_model": {
            "ai_model_key": [UQ, NN],
        },
        "dim_feature": {
            "feature_key": [UQ, NN],
        },
        "fact_ai_usage": {
            "ai_usage_key": [UQ, NN],
            "customer_key": [NN, REL("dim_customer", "customer_key")],
            "subscription_key": [NN, REL("dim_subscription", "subscription_key")],
            "date_key": [NN, REL("dim_date", "date_key")],
            "ai_model_key": [NN, REL("dim_ai_model", "ai_model_key")],
            "feature_key": [NN, REL("dim_feature", "feature_key")],
            "total_tokens": [NN],
        },
        "fact_payments": {
            "payment_key": [UQ, NN],
            "customer_key": [NN, REL("dim_customer", "customer_key")],
            "subscription_key": [NN, REL("dim_subscription", "subscription_key")],
            "date_key": [NN, REL("dim_date", "date_key")],
        },
        "fact_support_tickets": {
            "support_ticket_key": [UQ, NN],
            "customer_key": [NN, REL("dim_customer", "customer_key")],
            "submitted_date_key": [NN, REL("dim_date", "date_key")],
        },
    },
}


@dataclass(frozen=True)
class Check:
    check_id: str
    layer: str
    model: str
    column: str
    test: str
    arg: object


def all_checks(layers=None, tests=None) -> list[Check]:
    out = []
    for layer, models in DECLARED.items():
        if layers and layer not in layers:
            continue
        for model, columns in models.items():
            for column, declared in columns.items():
                for test, arg in declared:
                    if tests and test not in tests:
                        continue
                    out.append(Check(f"{test}_{model}_{column}", layer, model, column, test, arg))
    return out
