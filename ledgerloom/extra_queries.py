"""Registered queries beyond the plain models: checks, loaders, previews,
metrics and the pipeline run."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import oracle
from ledgerloom.operators import quality as Q
from ledgerloom.operators import staging as S
from ledgerloom.operators.checks import all_checks
from ledgerloom.operators.metrics import METRICS
from ledgerloom.plans.models import reads_of_payments
from ledgerloom.plans.pipeline import run_pipeline
from ledgerloom.plans.snapshots import Snapshots
from ledgerloom.session import run_dir
from ledgerloom.sources import driver_tables as DT
from ledgerloom.sources import landing as L
from ledgerloom.sources.ledger import Loader, ledger_summary
from ledgerloom.streaming.incremental import incremental_csv_load, read_target

# The landing partition used by the registered load queries.
INGESTION_DATE = "2026-10-02"
EVENT_YEAR, EVENT_MONTH = 2026, 9
EVENT_SOURCE_DIR = "events/ai_usage/year=2026/month=09"

DQ_KEYS = {
    "dq_not_null": ("not_null",),
    "dq_unique": ("unique",),
    "dq_accepted_values": ("accepted_values",),
    "dq_relationships": ("relationships",),
    "dq_expression": ("expression_is_true",),
}


def _ms(spark, sf_dir):
    from ledgerloom.registry import model_set
    return model_set(spark, sf_dir)


def _cmp(df):
    from ledgerloom.registry import comparable
    return comparable(df)


def _checked(spark: SparkSession, sf_dir: str, checks) -> DataFrame:
    """Store every relation the checks read once (shared folder), of the payments
    the columns they read, then run the checks over the stored tables."""
    ms = _ms(spark, sf_dir)
    read = {(c.model, c.column) for c in checks} | {c.arg for c in checks if c.test == "relationships"}
    ms.store(spark, {model for model, _ in read}, run_dir(spark, "dq"), columns={"payments": reads_of_payments(read)})
    return Q.run_checks(ms.__getitem__, checks, ms.origin)


def _dq(tests):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _checked(spark, sf_dir, all_checks(tests=tests)).drop("status")
    return run


def _dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, all_checks())


def _metric(name):
    fn, upstream = METRICS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _cmp(fn(_ms(spark, sf_dir)[upstream]))
    return run


def _preview(spark, sf_dir):
    return S.preview_events(DT.ai_usage_events(spark, sf_dir))


def _preview_alt(spark, sf_dir):
    return _cmp(S.preview_events_alt(DT.ai_usage_events(spark, sf_dir)))


def _load_csv(source):
    def run(spark, sf_dir):
        """Land a whole source as CSV, then COPY it back typed."""
        root = run_dir(spark, "landing")
        path = L.write_csv_landing(getattr(DT, source)(spark, sf_dir), root, source, INGESTION_DATE)
        return _cmp(L.load_csv(spark, path, source))
    return run


def _load_csv_line_breaks(spark, sf_dir):
    """Accounts landed with a line break in every name, read by records that span lines."""
    named = F.concat("account_name", F.lit("\nof "), F.coalesce("country", F.lit("nowhere")))
    accounts = DT.accounts(spark, sf_dir).withColumn("account_name", named)
    path = L.write_csv_landing(accounts, run_dir(spark, "landing"), "accounts", INGESTION_DATE)
    return _cmp(L.load_csv(spark, path, "accounts", multiline=True))


def _load_json(spark, sf_dir):
    """Land every event as a JSON line, load as VARIANT, flatten through staging."""
    root = run_dir(spark, "landing")
    path = L.write_json_landing(DT.event_json_lines(spark, sf_dir), root, EVENT_YEAR, EVENT_MONTH)
    raw = L.load_json_variant(spark, path, ingested_at=DT.FIXTURE_INGESTED_AT)
    stg = S.stg_ai_usage_events(raw)
    return stg.withColumn("source_file", L.relative_source_dir(F.col("source_file")))


def _landed(spark, sf_dir):
    root = run_dir(spark, "landing")
    L.write_landing(spark, sf_dir, root, INGESTION_DATE, EVENT_YEAR, EVENT_MONTH, compression="gzip")
    return root


def _landing_roundtrip(spark, sf_dir):
    """All five sources written to the landing layout and loaded back:
    rows and distinct ids per source."""
    root = _landed(spark, sf_dir)
    loaded = L.load_all(spark, root, ingested_at=DT.FIXTURE_INGESTED_AT)
    ids = {"accounts": F.col("account_id"), "subscriptions": F.col("subscription_id"),
           "payments": F.col("payment_id"), "support_tickets": F.col("ticket_id"),
           "ai_usage_events": F.variant_get("raw_event", "$.event_id", "string")}
    parts = [loaded[name].agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(idc).alias("distinct_ids"))
                         .select(F.lit(name).alias("source"), "rows", "distinct_ids")
             for name, idc in ids.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _incremental(spark, sf_dir):
    """Stream-load landed support tickets twice (availableNow); the second run
    must add nothing, so the target equals the source exactly once."""
    root = run_dir(spark, "incremental")
    path = L.write_csv_landing(DT.support_tickets(spark, sf_dir), os.path.join(root, "landing"),
                               "support_tickets", INGESTION_DATE)
    target, ck = os.path.join(root, "raw_support_tickets"), os.path.join(root, "_checkpoint")
    incremental_csv_load(spark, path, "support_tickets", target, ck)
    incremental_csv_load(spark, path, "support_tickets", target, ck)
    return _cmp(read_target(spark, target, "support_tickets"))


def _load_ledger(spark, sf_dir):
    """All sources loaded through the ledger, twice: the second load finds
    nothing new, so each source has its rows once, from one load."""
    root, landing = run_dir(spark, "ledger"), _landed(spark, sf_dir)
    snapshots = Snapshots(spark, root)
    for _ in range(2):
        loader = Loader(spark, snapshots)
        loader.commit([loader.stage(name, landing, ingested_at=DT.FIXTURE_INGESTED_AT) for name in L.LANDING_PREFIX])
    loader = Loader(spark, snapshots)
    sums = ledger_summary(loader.ledger()).select("source", F.col("rows").alias("ledger_rows"), "loads")
    tables = [loader.rows(name).agg(F.count(F.lit(1)).alias("table_rows")).withColumn("source", F.lit(name)) for name in L.LANDING_PREFIX]
    return reduce(DataFrame.unionByName, tables).join(sums, "source").select("source", "table_rows", "ledger_rows", "loads")


def _landed_by_month(spark, sf_dir):
    root = run_dir(spark, "landing")
    L.write_landing(spark, sf_dir, root, INGESTION_DATE)
    return root


def _stage_listing(spark, sf_dir):
    """The landed stage by source and partition folder, events in the folder of their month."""
    return L.stage_folders(spark, _landed_by_month(spark, sf_dir))


def _source_presence(spark, sf_dir):
    """The five sources, and every month of the years that have events: a month
    without events has no folder."""
    root = _landed_by_month(spark, sf_dir)
    years = DT.read_table(spark, sf_dir, "events", "ts").agg(F.min(F.year("ts")), F.max(F.year("ts"))).first()
    prefixes = list(L.LANDING_PREFIX.items())
    if years[0] is not None:
        prefixes += [("ai_usage_events", f"{L.LANDING_PREFIX['ai_usage_events']}/year={y:04d}/month={m:02d}")
                     for y in range(years[0], years[1] + 1) for m in range(1, 13)]
    return L.source_presence(spark, root, prefixes)


def _pipeline_summary(spark, sf_dir):
    """Land the driver-derived sources, run the whole job, report rows per
    relation and the number of failing data tests (seeded on purpose, so the
    run reports instead of raising)."""
    root = _landed(spark, sf_dir)
    res = run_pipeline(spark, root, run_dir(spark, "warehouse"), as_of=DT.FIXTURE_AS_OF,
                       ingested_at=DT.FIXTURE_INGESTED_AT, on_check_failure="warn")
    return res.summary()


def queries() -> dict:
    out = {k: _dq(t) for k, t in DQ_KEYS.items()}
    out["dq_report"] = _dq_report
    out.update({name: _metric(name) for name in METRICS})
    out.update({
        "preview_events": _preview,
        "preview_events_alt": _preview_alt,
        "load_csv": _load_csv("payments"),
        "load_accounts": _load_csv("accounts"),
        "load_subscriptions": _load_csv("subscriptions"),
        "load_support_tickets": _load_csv("support_tickets"),
        "load_csv_line_breaks": _load_csv_line_breaks,
        "load_json_variant": _load_json,
        "landing_roundtrip": _landing_roundtrip,
        "incremental_load": _incremental,
        "load_ledger": _load_ledger,
        "stage_listing": _stage_listing,
        "source_presence": _source_presence,
        "pipeline_summary": _pipeline_summary,
    })
    return out


def oracle_sql() -> dict:
    out = {k: oracle.checks_sql(all_checks(tests=t)) for k, t in DQ_KEYS.items()}
    out["dq_report"] = oracle.checks_sql(all_checks(), with_status=True)
    out.update(oracle.EXTRA_SQL)
    out["load_json_variant"] = oracle.with_models(
        f"SELECT * REPLACE ('{EVENT_SOURCE_DIR}' AS source_file) FROM stg_ai_usage_events")
    out["pipeline_summary"] = oracle.pipeline_summary_sql(all_checks())
    return out
