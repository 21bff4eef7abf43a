"""Raw tables derived from the driver's TPC-H-style parquet tables.

The reference ships no data, so its five raw sources are mapped from the
driver tables with plain column expressions (no UDF, no driver round trip):

    accounts         customer ⋈ nation, and supplier ⋈ nation (these own nothing)
    subscriptions    every order
    payments         every lineitem ⋈ orders
    support_tickets  every event; its type decides priority and escalation
    ai_usage_events  every event, rendered as a JSON object → VARIANT

Each function reads only the columns it needs, so the parquet scans carry a
pruned ``ReadSchema``. No row of a driver table is left out.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import PAYMENT_METHODS, PLAN_TIERS, PRIORITIES

# Fixed values used by the mapping (valid for every scale factor).
SIGNUP_EPOCH = "1995-01-01"
REFERRAL_SOURCES = ("Organic", "Partner", "Ads")
# event_type → ticket priority; other types get the last one.
TICKET_PRIORITY = {"error": PRIORITIES[0], "signup": PRIORITIES[1], "purchase": PRIORITIES[2]}
SUPPLIER_INDUSTRY = "PARTNER"
# event_type → raw status text; the padding and mixed case are on purpose, the
# models normalise them differently.
EVENT_STATUS_TEXT = {
    "error": "failed",
    "signup": "timeout",
    "click": " Success ",
    "view": "error",
    "purchase": "success",
}
FIXTURE_SOURCE_FILE = "events/ai_usage/year=2026/month=09/ai_usage_events.json"
FIXTURE_INGESTED_AT = "2026-10-02 00:00:00"
FIXTURE_AS_OF = "2026-10-02"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan of one driver table."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*cols) if cols else df


def _cycle(k: Column, values) -> Column:
    """values[k % len(values)] as a CASE expression."""
    m = k % len(values)
    out = F.when(m == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:-1], start=1):
        out = out.when(m == i, F.lit(v))
    return out.otherwise(F.lit(values[-1]))


def _id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), *[p.cast("string") for p in parts])


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, and suppliers as accounts without subscriptions, payments or
    tickets (their measures are zero-filled)."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey",
                   "c_acctbal", "c_mktsegment").toDF("k", "name", "nation", "balance", "industry")
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal") \
        .toDF("k", "name", "nation", "balance")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    owners = c.select(_id("A-", F.col("k")).alias("account_id"), "k", "name", "nation", "balance", "industry").unionAll(
        s.select(_id("V-", F.col("k")).alias("account_id"), "k", "name", "nation", "balance",
                 F.lit(SUPPLIER_INDUSTRY).alias("industry")))
    k = F.col("k")
    return owners.join(n, F.col("nation") == n.n_nationkey, "inner").select(
        "account_id",
        F.col("name").alias("account_name"),
        "industry",
        F.col("n_name").alias("country"),
        F.date_add(F.lit(SIGNUP_EPOCH).cast("date"), (k % 1500).cast("int")).alias("signup_date"),
        _cycle(k, REFERRAL_SOURCES).alias("referral_source"),
        _cycle(k, PLAN_TIERS).alias("plan_tier"),
        (k % 50 + 1).cast("decimal(10,0)").alias("seats"),
        (k % 7 == 0).alias("is_trial"),
        (F.col("balance") < 0).alias("churn_flag"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    mrr = F.col("o_totalprice").cast("decimal(12,2)")
    prio = F.col("o_orderpriority")
    return o.select(
        _id("S-", k).alias("subscription_id"),
        _id("A-", F.col("o_custkey")).alias("account_id"),
        F.col("o_orderdate").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        _cycle(k, PLAN_TIERS).alias("plan_tier"),
        F.when(k % 97 != 0, (k % 25 + 1).cast("decimal(10,0)")).alias("seats"),
        mrr.alias("mrr_amount"),
        (mrr * 12).cast("decimal(14,2)").alias("arr_amount"),
        (prio == "5-LOW").alias("is_trial"),
        (prio == "1-URGENT").alias("upgrade_flag"),
        (prio == "4-NOT SPECIFIED").alias("downgrade_flag"),
        (F.col("o_orderstatus") == "F").alias("churn_flag"),
        F.when(k % 2 == 0, F.lit("Monthly")).otherwise(F.lit("Annual")).alias("billing_frequency"),
        (F.col("o_orderstatus") == "O").alias("auto_renew_flag"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate") \
        .withColumn("l_shipdate", F.col("l_shipdate").cast("date"))        # a date is shuffled in fewer bytes
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    ship = F.col("l_shipdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        _id("P-", F.col("l_orderkey"), F.lit("-"), F.col("l_partkey"), F.lit("-"),
            F.col("l_suppkey"), F.lit("-"), F.col("l_linenumber"), F.lit("-"), ship).alias("payment_id"),
        _id("A-", F.col("o_custkey")).alias("account_id"),
        _id("S-", F.col("l_orderkey")).alias("subscription_id"),
        ship.alias("payment_date"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(F.col("l_returnflag") == "R", F.lit("Failed")).otherwise(F.lit("Succeeded")).alias("payment_status"),
        _cycle(F.col("l_suppkey"), PAYMENT_METHODS).alias("payment_method"),
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    priority = F.lit(PRIORITIES[3])
    for kind, level in TICKET_PRIORITY.items():
        priority = F.when(F.col("event_type") == kind, F.lit(level)).otherwise(priority)
    k = F.col("event_id")
    return ev.select(
        _id("T-", k).alias("ticket_id"),
        _id("A-", F.col("user_id")).alias("account_id"),
        F.col("ts").alias("submitted_at"),
        F.when(k % 5 != 0, F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("closed_at"),
        F.col("value").cast("decimal(10,2)").alias("resolution_time_hours"),
        priority.alias("priority"),
        (k % 120).cast("decimal(10,2)").alias("first_response_time_minutes"),
        F.when(k % 9 != 0, (k % 5 + 1).cast("decimal(3,1)")).alias("satisfaction_score"),
        (F.col("event_type") == "error").alias("escalation_flag"),
    )


def event_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One struct (column ``event``) per event with the JSON record's fields.

    ``subscription_id`` cycles over the number of orders, a scalar subquery
    (one count, planned once) so the share of dangling ids is the same at every
    scale factor. NULL fields are absent from the rendered JSON.
    """
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    n_orders = read_table(spark, sf_dir, "orders", "o_orderkey").select(F.count(F.lit(1))).scalar()
    k = F.col("event_id")
    status = F.col("event_type")
    status_text = None
    for et, text in EVENT_STATUS_TEXT.items():
        status_text = (F.when(status == et, F.lit(text)) if status_text is None
                       else status_text.when(status == et, F.lit(text)))
    obj = F.struct(
        _id("E-", k).alias("event_id"),
        F.when(k % 3 == 0, F.concat(F.lit(" A-"), F.col("user_id").cast("string"), F.lit(" ")))
         .otherwise(_id("A-", F.col("user_id"))).alias("account_id"),
        _id("S-", k % n_orders).alias("subscription_id"),
        F.substring(F.col("ts").cast("string"), 1, 19).alias("event_timestamp"),
        F.when(k % 50 != 0, _id("model-", k % 3)).alias("model"),
        _id("feature-", k % 4).alias("feature"),
        (k % 400).alias("input_tokens"),
        F.when(k % 11 != 0, k % 300).alias("output_tokens"),
        (k % 2000).alias("latency_ms"),
        status_text.alias("status"),
    )
    return ev.select(obj.alias("event"))


def event_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per line (column ``value``), as the landing files hold them."""
    return event_objects(spark, sf_dir).select(F.to_json("event").alias("value"))


def ai_usage_events(spark: SparkSession, sf_dir: str,
                    source_file: str = FIXTURE_SOURCE_FILE,
                    ingested_at: str = FIXTURE_INGESTED_AT) -> DataFrame:
    """RAW.AI_USAGE_EVENTS: the event as VARIANT plus lineage columns.

    The object is converted to VARIANT directly (same value as parsing its
    JSON line); the JSON text path is exercised by the landing loader.
    """
    return event_objects(spark, sf_dir).select(
        F.to_variant_object("event").alias("raw_event"),
        F.lit(source_file).alias("source_file"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("ingested_at"),
    )


RAW_BUILDERS = {
    "accounts": accounts,
    "subscriptions": subscriptions,
    "payments": payments,
    "support_tickets": support_tickets,
    "ai_usage_events": ai_usage_events,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict:
    """Raw table builders (called on first use, so a query plans only the
    sources it reads)."""
    return {name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in RAW_BUILDERS.items()}
