"""Star schema: four dimensions, three facts, and the declared ``dim_date``.

All marts read staging only (as in the reference); natural keys are copied to
``*_key`` columns, no surrogate keys are generated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dim_customer(stg_accounts: DataFrame) -> DataFrame:
    return stg_accounts.select(
        F.col("account_id").alias("customer_key"),
        "account_id", "account_name", "industry", "country", "signup_date",
        "referral_source", "plan_tier", "is_trial", "churn_flag",
    )


def dim_subscription(stg_subscriptions: DataFrame) -> DataFrame:
    return stg_subscriptions.select(
        F.col("subscription_id").alias("subscription_key"),
        "subscription_id",
        F.col("account_id").alias("customer_key"),
        "plan_tier", "start_date", "billing_frequency", "seats", "mrr_amount", "arr_amount",
        "is_trial", "upgrade_flag", "downgrade_flag", "churn_flag", "auto_renew_flag",
    )


def _distinct_dim(events: DataFrame, col: str, key: str) -> DataFrame:
    # filter sits under the aggregate and is pushed to the scan; the distinct is
    # a partial + final aggregate, so each task ships only its distinct values
    return (events.where(F.col(col).isNotNull())
                  .select(F.col(col).alias(key), F.col(col)).distinct())


def dim_ai_model(stg_ai_usage_events: DataFrame) -> DataFrame:
    return _distinct_dim(stg_ai_usage_events, "model_name", "ai_model_key")


def dim_feature(stg_ai_usage_events: DataFrame) -> DataFrame:
    return _distinct_dim(stg_ai_usage_events, "feature_name", "feature_key")


def fact_ai_usage(stg_ai_usage_events: DataFrame) -> DataFrame:
    """Success is the exact lower-case text ``success``; any other non-NULL
    status is a failure; a NULL status is neither."""
    status = F.col("status")
    return stg_ai_usage_events.select(
        F.col("event_id").alias("ai_usage_key"),
        "event_id",
        F.col("account_id").alias("customer_key"),
        F.col("subscription_id").alias("subscription_key"),
        F.col("event_timestamp").cast("date").alias("date_key"),
        F.col("model_name").alias("ai_model_key"),
        F.col("feature_name").alias("feature_key"),
        "input_tokens", "output_tokens", "total_tokens", "latency_ms", "status", "error_type",
        F.when(status == "success", F.lit(1)).otherwise(F.lit(0)).alias("success_flag"),
        F.when(status != "success", F.lit(1)).otherwise(F.lit(0)).alias("failure_flag"),
        "source_file", "ingested_at",
    )


def fact_payments(stg_payments: DataFrame) -> DataFrame:
    status = F.col("payment_status")
    return stg_payments.select(
        F.col("payment_id").alias("payment_key"),
        "payment_id",
        F.col("account_id").alias("customer_key"),
        F.col("subscription_id").alias("subscription_key"),
        F.col("payment_date").cast("date").alias("date_key"),
        "amount", "currency", "payment_status", "payment_method",
        F.when(status == "Succeeded", F.lit(1)).otherwise(F.lit(0)).alias("successful_payment_flag"),
        F.when(status == "Failed", F.lit(1)).otherwise(F.lit(0)).alias("failed_payment_flag"),
    )


def fact_support_tickets(stg_support_tickets: DataFrame) -> DataFrame:
    return stg_support_tickets.select(
        F.col("ticket_id").alias("support_ticket_key"),
        "ticket_id",
        F.col("account_id").alias("customer_key"),
        F.col("submitted_at").cast("date").alias("submitted_date_key"),
        F.col("closed_at").cast("date").alias("closed_date_key"),
        "submitted_at", "closed_at", "resolution_time_hours", "priority",
        "first_response_time_minutes", "satisfaction_score", "escalation_flag",
        F.when(F.col("closed_at").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("resolved_flag"),
        F.when(F.col("escalation_flag") == F.lit(True), F.lit(1)).otherwise(F.lit(0)).alias("escalation_count"),
    )


def dim_date(fact_ai_usage: DataFrame, fact_payments: DataFrame,
             fact_support_tickets: DataFrame) -> DataFrame:
    """Calendar spanning every fact date key (NULL keys — open tickets — ignored).

    Each fact contributes only its min/max (a global partial aggregate, one
    row per task), so the calendar costs one tiny job; the exploded span is
    bounded by the number of days between the first and last date, not by
    the data volume.
    """
    bounds = [
        fact_ai_usage.agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi")),
        fact_payments.agg(F.min("date_key").alias("lo"), F.max("date_key").alias("hi")),
        fact_support_tickets.agg(
            F.least(F.min("submitted_date_key"), F.min("closed_date_key")).alias("lo"),
            F.greatest(F.max("submitted_date_key"), F.max("closed_date_key")).alias("hi")),
    ]
    span = reduce(DataFrame.unionByName, bounds).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    d = F.col("date_key")
    return (span.where(F.col("lo").isNotNull())
                .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_key"))
                .select(
                    d,
                    F.year(d).cast("bigint").alias("year"),
                    F.quarter(d).cast("bigint").alias("quarter"),
                    F.month(d).cast("bigint").alias("month"),
                    F.dayofmonth(d).cast("bigint").alias("day_of_month"),
                    (F.weekday(d) + 1).cast("bigint").alias("iso_day_of_week"),
                    F.weekofyear(d).cast("bigint").alias("iso_week"),
                    F.date_format(d, "EEEE").alias("day_name"),
                    F.date_format(d, "MMMM").alias("month_name"),
                    (F.weekday(d) >= 5).alias("is_weekend"),
                ))
