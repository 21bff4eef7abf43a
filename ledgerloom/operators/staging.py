"""Staging models: pass-through views over the raw tables, plus the event flatten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.variant import v_dec, v_int, v_str, v_ts


def stg_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select("*")


def stg_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select("*")


def stg_payments(payments: DataFrame) -> DataFrame:
    return payments.select("*")


def stg_support_tickets(support_tickets: DataFrame) -> DataFrame:
    return support_tickets.select("*")


def stg_ai_usage_events(ai_usage_events: DataFrame) -> DataFrame:
    """Typed columns from the VARIANT event (14 columns).

    ``model`` / ``feature`` are renamed ``model_name`` / ``feature_name``;
    ``total_tokens`` counts a missing side as 0.
    """
    v = F.col("raw_event")
    inp, out = v_int(v, "input_tokens"), v_int(v, "output_tokens")
    return ai_usage_events.select(
        v_str(v, "event_id").alias("event_id"),
        v_str(v, "account_id").alias("account_id"),
        v_str(v, "subscription_id").alias("subscription_id"),
        v_ts(v, "event_timestamp").alias("event_timestamp"),
        v_str(v, "model").alias("model_name"),
        v_str(v, "feature").alias("feature_name"),
        inp.alias("input_tokens"),
        out.alias("output_tokens"),
        (F.coalesce(inp, F.lit(0)) + F.coalesce(out, F.lit(0))).alias("total_tokens"),
        v_int(v, "latency_ms").alias("latency_ms"),
        v_str(v, "status").alias("status"),
        v_str(v, "error_type").alias("error_type"),
        F.col("source_file"),
        F.col("ingested_at"),
    )


def preview_events(ai_usage_events: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` flattened events (8 fields), ordered by event id for stability.

    Planned as a per-partition top-n followed by one merge
    (``TakeOrderedAndProject``), never a full sort.
    """
    v = F.col("raw_event")
    return ai_usage_events.select(
        v_str(v, "event_id").alias("event_id"),
        v_str(v, "account_id").alias("account_id"),
        v_str(v, "model").alias("model"),
        v_str(v, "feature").alias("feature"),
        v_int(v, "input_tokens").alias("input_tokens"),
        v_int(v, "output_tokens").alias("output_tokens"),
        v_int(v, "latency_ms").alias("latency_ms"),
        v_str(v, "status").alias("status"),
    ).orderBy("event_id").limit(n)


def preview_events_alt(ai_usage_events: DataFrame, n: int = 10) -> DataFrame:
    """Preview under the alternative field names; absent keys come back NULL."""
    v = F.col("raw_event")
    return ai_usage_events.select(
        v_str(v, "event_id").alias("event_id"),
        v_str(v, "account_id").alias("account_id"),
        v_ts(v, "event_timestamp").alias("event_timestamp"),
        v_str(v, "model_name").alias("model_name"),
        v_str(v, "feature_name").alias("feature_name"),
        v_int(v, "tokens_used").alias("tokens_used"),
        v_dec(v, "cost", 18, 6).alias("cost"),
    ).orderBy("event_id").limit(n)
