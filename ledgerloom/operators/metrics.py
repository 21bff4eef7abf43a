"""Consumer metrics the marts serve (MRR/ARR, payment rates, churn pressure,
support burden, AI reliability) — thin aggregates over models and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.variant import avg_exact, exact_ratio


def metric_mrr_arr(dim_subscription: DataFrame) -> DataFrame:
    return dim_subscription.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("subscription_count"),
        F.sum("mrr_amount").alias("total_mrr"),
        F.sum("arr_amount").alias("total_arr"),
    )


def metric_payment_rates(int_account_revenue: DataFrame) -> DataFrame:
    return int_account_revenue.select(
        "account_id", "payment_count", "successful_payment_count", "failed_payment_count",
        exact_ratio(F.col("successful_payment_count"), F.col("payment_count")).alias("payment_success_rate"),
        exact_ratio(F.col("failed_payment_count"), F.col("payment_count")).alias("payment_failure_rate"),
    )


def metric_churn_pressure(dim_subscription: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    churned = F.count_if(F.col("churn_flag") == F.lit(True))
    downgraded = F.count_if(F.col("downgrade_flag") == F.lit(True))
    return dim_subscription.groupBy("plan_tier").agg(
        n.alias("subscription_count"),
        churned.alias("churned_count"),
        downgraded.alias("downgraded_count"),
        F.count_if(F.col("upgrade_flag") == F.lit(True)).alias("upgraded_count"),
        exact_ratio(churned, n).alias("churn_rate"),
        exact_ratio(downgraded, n).alias("downgrade_rate"),
    )


def metric_support_burden(int_customer_360: DataFrame) -> DataFrame:
    return int_customer_360.select(
        "account_id", "plan_tier", "subscription_count", "total_support_tickets",
        "escalated_ticket_count", "avg_resolution_time_hours", "avg_first_response_time_minutes",
        "avg_satisfaction_score",
        exact_ratio(F.col("escalated_ticket_count"), F.col("total_support_tickets")).alias("escalation_rate"),
        exact_ratio(F.col("total_support_tickets"), F.col("subscription_count")).alias("tickets_per_subscription"),
    )


def metric_ai_reliability(fact_ai_usage: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return fact_ai_usage.groupBy("ai_model_key", "feature_key").agg(
        n.alias("event_count"),
        F.sum("total_tokens").alias("total_tokens"),
        avg_exact(F.col("latency_ms")).alias("avg_latency_ms"),
        exact_ratio(F.sum("success_flag"), n).alias("success_rate"),
        exact_ratio(F.sum("failure_flag"), n).alias("failure_rate"),
    )


METRICS = {
    "metric_mrr_arr": (metric_mrr_arr, "dim_subscription"),
    "metric_payment_rates": (metric_payment_rates, "int_account_revenue"),
    "metric_churn_pressure": (metric_churn_pressure, "dim_subscription"),
    "metric_support_burden": (metric_support_burden, "int_customer_360"),
    "metric_ai_reliability": (metric_ai_reliability, "fact_ai_usage"),
}
