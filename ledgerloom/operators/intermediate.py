"""Intermediate models: one row per account / subscription / event.

Every model aggregates each fact to its join key *before* joining, so joins
are 1:1 (or N:1 onto a one-row-per-key side) and never fan out. ``groupBy``
plans a partial (map-side) aggregate before its shuffle, so one account owning
a third of all payments still reaches the shuffle as one row per map task.
Joins onto accounts meet one row a key on both sides and are plain. The join of
subscriptions onto their account's support figures is N:1 and goes through
``salted_left_join``: an account may hold a large share of the subscriptions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.variant import avg_exact, exact_ratio, month_start, utc_now
from ledgerloom.operators.joins import salted_left_join

ACCOUNT_ATTRS = ("account_id", "account_name", "industry", "country", "signup_date",
                 "referral_source", "plan_tier", "is_trial", "churn_flag")


def _is_true(c: str) -> Column:
    # ``flag = TRUE``: NULL is neither true nor false
    return F.col(c) == F.lit(True)


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).alias(c)


def _as_of_date(as_of) -> Column:
    return utc_now().cast("date") if as_of is None else F.lit(str(as_of)).cast("date")


def _subscriptions_per_account(subscriptions: DataFrame) -> DataFrame:
    """Subscription metrics for int_account_revenue.

    The two ``COUNT(DISTINCT …)`` share one distinct key (subscription_id), so
    instead of Spark's ``Expand`` (which doubles the rows) the rows are first
    reduced per (account, subscription) — that shuffle also spreads a hot
    account over many partitions — and then per account.
    """
    per_sub = subscriptions.groupBy("account_id", "subscription_id").agg(
        F.max(F.col("churn_flag") == F.lit(False)).alias("_active"),
        F.sum(F.coalesce("seats", F.lit(0))).alias("_seats"),
        F.sum(F.coalesce("mrr_amount", F.lit(0))).alias("_mrr"),
        F.sum(F.coalesce("arr_amount", F.lit(0))).alias("_arr"),
        F.min("start_date").alias("_first"),
        F.max("start_date").alias("_latest"),
        F.count_if(_is_true("upgrade_flag")).alias("_up"),
        F.count_if(_is_true("downgrade_flag")).alias("_down"),
        F.count_if(_is_true("churn_flag")).alias("_churn"),
        F.count_if(_is_true("auto_renew_flag")).alias("_renew"),
    )
    return per_sub.groupBy("account_id").agg(
        F.count("subscription_id").alias("subscription_count"),
        F.count_if(F.col("subscription_id").isNotNull() & F.coalesce(F.col("_active"), F.lit(False)))
        .alias("active_subscription_count"),
        F.sum("_seats").alias("total_seats"),
        F.sum("_mrr").alias("mrr_amount"),
        F.sum("_arr").alias("arr_amount"),
        F.min("_first").alias("first_subscription_date"),
        F.max("_latest").alias("latest_subscription_date"),
        F.sum("_up").alias("upgrade_count"),
        F.sum("_down").alias("downgrade_count"),
        F.sum("_churn").alias("churned_subscription_count"),
        F.sum("_renew").alias("auto_renew_subscription_count"),
    )


def int_account_revenue(stg_accounts: DataFrame, stg_subscriptions: DataFrame,
                        stg_payments: DataFrame) -> DataFrame:
    accounts = stg_accounts.select(*ACCOUNT_ATTRS)
    subs = _subscriptions_per_account(stg_subscriptions)

    ok = F.col("payment_status") == "Succeeded"
    failed = F.col("payment_status") == "Failed"
    amount0 = F.coalesce(F.col("amount"), F.lit(0))
    pays = stg_payments.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.count_if(ok).alias("successful_payment_count"),
        F.count_if(failed).alias("failed_payment_count"),
        F.sum(F.when(ok, amount0).otherwise(F.lit(0))).alias("total_revenue"),
        F.sum(F.when(failed, amount0).otherwise(F.lit(0))).alias("failed_payment_amount"),
        F.min(F.when(ok, F.col("payment_date"))).alias("first_payment_date"),
        F.max(F.when(ok, F.col("payment_date"))).alias("last_payment_date"),
        avg_exact(F.when(ok, F.col("amount"))).alias("average_payment_amount"),
    )
    joined = accounts.join(subs, "account_id", "left").join(pays, "account_id", "left")
    return joined.select(
        *ACCOUNT_ATTRS,
        _zero("subscription_count"), _zero("active_subscription_count"), _zero("total_seats"),
        _zero("mrr_amount"), _zero("arr_amount"),
        "first_subscription_date", "latest_subscription_date",
        _zero("upgrade_count"), _zero("downgrade_count"), _zero("churned_subscription_count"),
        _zero("auto_renew_subscription_count"),
        _zero("payment_count"), _zero("successful_payment_count"), _zero("failed_payment_count"),
        _zero("total_revenue"), _zero("failed_payment_amount"),
        "first_payment_date", "last_payment_date",
        _zero("average_payment_amount"),
    )


def _support_per_account(stg_support_tickets: DataFrame, count_name: str) -> DataFrame:
    return stg_support_tickets.groupBy("account_id").agg(
        F.count(F.lit(1)).alias(count_name),
        F.count_if(_is_true("escalation_flag")).alias("escalated_ticket_count"),
        avg_exact(F.col("resolution_time_hours")).alias("avg_resolution_time_hours"),
        avg_exact(F.col("first_response_time_minutes")).alias("avg_first_response_time_minutes"),
        avg_exact(F.col("satisfaction_score")).alias("avg_satisfaction_score"),
    )


def _succeeded_totals(stg_payments: DataFrame, key: str, amount_name: str, *extra) -> DataFrame:
    ok = F.col("payment_status") == "Succeeded"
    return stg_payments.groupBy(key).agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.count_if(ok).alias("successful_payment_count"),
        F.count_if(F.col("payment_status") == "Failed").alias("failed_payment_count"),
        F.sum(F.when(ok, F.col("amount")).otherwise(F.lit(0))).alias(amount_name),
        *extra,
    )


def int_subscription_metrics(stg_subscriptions: DataFrame, stg_payments: DataFrame,
                             stg_support_tickets: DataFrame, as_of=None) -> DataFrame:
    """One row per subscription; support metrics are the *account's* (repeated
    on each of its subscriptions). ``as_of`` replaces CURRENT_DATE()."""
    subs = stg_subscriptions.select(
        "subscription_id", "account_id", "plan_tier", "start_date", "billing_frequency",
        "seats", "mrr_amount", "arr_amount", "is_trial", "upgrade_flag", "downgrade_flag",
        "churn_flag", "auto_renew_flag")
    pays = _succeeded_totals(stg_payments, "subscription_id", "total_payment_amount",
                             F.max("payment_date").alias("last_payment_date"))
    support = _support_per_account(stg_support_tickets, "support_ticket_count")
    # N:1 onto the account: an account may own a large share of subscriptions
    joined = (salted_left_join(subs, support, "account_id", spread_by="subscription_id")
              .join(pays, "subscription_id", "left"))
    return joined.select(
        "subscription_id", "account_id", "plan_tier", "start_date", "billing_frequency",
        "seats", "mrr_amount", "arr_amount", "is_trial", "upgrade_flag", "downgrade_flag",
        "churn_flag", "auto_renew_flag",
        F.datediff(_as_of_date(as_of), F.col("start_date")).cast("bigint").alias("subscription_age_days"),
        _zero("payment_count"), _zero("successful_payment_count"), _zero("failed_payment_count"),
        _zero("total_payment_amount"),
        "last_payment_date",
        _zero("support_ticket_count"), _zero("avg_resolution_time_hours"),
        _zero("avg_first_response_time_minutes"), _zero("avg_satisfaction_score"),
        _zero("escalated_ticket_count"),
    )


def int_customer_360(stg_accounts: DataFrame, stg_subscriptions: DataFrame,
                     stg_payments: DataFrame, stg_support_tickets: DataFrame) -> DataFrame:
    accounts = stg_accounts.select(*ACCOUNT_ATTRS)
    subs = stg_subscriptions.groupBy("account_id").agg(
        F.count_distinct("subscription_id").alias("subscription_count"),
        F.sum("mrr_amount").alias("total_mrr"),
        F.sum("arr_amount").alias("total_arr"),
        F.sum("seats").alias("total_seats"),
        F.max("start_date").alias("latest_subscription_start_date"),
        F.count_if(_is_true("upgrade_flag")).alias("upgrade_count"),
        F.count_if(_is_true("downgrade_flag")).alias("downgrade_count"),
        F.count_if(_is_true("churn_flag")).alias("churned_subscription_count"),
    )
    pays = _succeeded_totals(stg_payments, "account_id", "total_revenue")
    support = _support_per_account(stg_support_tickets, "total_support_tickets")
    joined = (accounts.join(subs, "account_id", "left").join(pays, "account_id", "left")
              .join(support, "account_id", "left"))
    return joined.select(
        *ACCOUNT_ATTRS,
        _zero("subscription_count"), _zero("total_mrr"), _zero("total_arr"), _zero("total_seats"),
        "latest_subscription_start_date",
        _zero("upgrade_count"), _zero("downgrade_count"), _zero("churned_subscription_count"),
        _zero("payment_count"), _zero("successful_payment_count"), _zero("failed_payment_count"),
        _zero("total_revenue"),
        _zero("total_support_tickets"), _zero("escalated_ticket_count"),
        _zero("avg_resolution_time_hours"), _zero("avg_first_response_time_minutes"),
        _zero("avg_satisfaction_score"),
    )


def int_ai_usage_metrics(stg_ai_usage_events: DataFrame) -> DataFrame:
    """One row per event: trimmed ids, calendar keys, normalised status, flags.

    ``latency_per_token`` is an exact decimal (scale 6); 0 when there are no
    tokens, NULL when latency is NULL.
    """
    status = F.upper(F.trim(F.col("status")))
    tokens = F.col("total_tokens")
    return stg_ai_usage_events.select(
        "event_id",
        F.trim(F.col("account_id")).alias("account_id"),
        F.trim(F.col("subscription_id")).alias("subscription_id"),
        "event_timestamp",
        F.col("event_timestamp").cast("date").alias("event_date"),
        month_start(F.col("event_timestamp")).alias("event_month"),
        "model_name", "feature_name", "input_tokens", "output_tokens", "total_tokens", "latency_ms",
        status.alias("status"),
        "error_type",
        F.when(status == "SUCCESS", F.lit(1)).otherwise(F.lit(0)).alias("is_success"),
        F.when(status.isin("FAILED", "ERROR", "TIMEOUT"), F.lit(1)).otherwise(F.lit(0)).alias("is_failure"),
        F.when(F.coalesce(tokens, F.lit(0)) == 0, F.lit(0).cast("decimal(38,6)"))
         .otherwise(exact_ratio(F.col("latency_ms"), tokens)).alias("latency_per_token"),
        "source_file", "ingested_at",
    )
