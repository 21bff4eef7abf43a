"""Invariants of the models, seeded check violations, pipeline behaviour."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import quality as Q
from ledgerloom.operators.checks import all_checks
from ledgerloom.plans import models as PM
from ledgerloom.plans.pipeline import PipelineError, run_pipeline
from ledgerloom.registry import model_set
from ledgerloom.session import run_dir
from ledgerloom.sources import landing as L
from tests.conftest import SF0001, SF001


@pytest.fixture(scope="module")
def ms(spark):
    return model_set(spark, SF0001)


def test_check_catalog_counts():
    cs = all_checks()
    assert len(cs) == 153
    assert len({c.check_id for c in cs}) == 153
    by_layer = {l: sum(c.layer == l for c in cs) for l in ("source", "intermediate", "marts")}
    assert by_layer == {"source": 63, "intermediate": 51, "marts": 39}
    by_test = {}
    for c in cs:
        by_test[c.test] = by_test.get(c.test, 0) + 1
    assert by_test == {"not_null": 92, "unique": 16, "accepted_values": 16,
                       "relationships": 19, "expression_is_true": 10}


def test_no_fan_out(ms):
    n_acc = ms["stg_accounts"].count()
    assert ms["int_account_revenue"].count() == n_acc
    assert ms["int_customer_360"].count() == n_acc
    assert ms["int_subscription_metrics"].count() == ms["stg_subscriptions"].count()
    assert ms["fact_payments"].count() == ms["stg_payments"].count()
    assert ms["fact_ai_usage"].count() == ms["stg_ai_usage_events"].count()
    assert ms["fact_support_tickets"].count() == ms["stg_support_tickets"].count()


def test_metric_invariants(ms):
    rev = ms["int_account_revenue"]
    assert rev.where(F.col("successful_payment_count") + F.col("failed_payment_count")
                     > F.col("payment_count")).count() == 0
    assert rev.where(F.col("active_subscription_count") > F.col("subscription_count")).count() == 0
    met = ms["int_ai_usage_metrics"]
    assert met.where((F.col("is_success") == 1) & (F.col("is_failure") == 1)).count() == 0
    # accounts without subscriptions: zero-filled measures, NULL dates
    empty = rev.where(F.col("subscription_count") == 0).collect()
    assert empty and all(r.first_subscription_date is None and r.mrr_amount == 0 for r in empty)


def test_support_metrics_repeat_per_subscription(ms):
    sub = ms["int_subscription_metrics"]
    per_acc = sub.groupBy("account_id").agg(F.countDistinct("support_ticket_count").alias("k"))
    assert per_acc.where(F.col("k") > 1).count() == 0


def test_dim_date_covers_fact_keys(ms):
    d = ms["dim_date"]
    assert d.count() == d.select("date_key").distinct().count()
    for fact, col in [("fact_payments", "date_key"), ("fact_ai_usage", "date_key"),
                      ("fact_support_tickets", "submitted_date_key")]:
        assert ms[fact].join(d, ms[fact][col] == d.date_key, "left_anti").count() == 0


def test_seeded_violations_sf001(spark):
    ms = model_set(spark, SF001)
    want = {
        "not_null_subscriptions_seats": 155,
        "not_null_support_tickets_closed_at": 2000,
        "not_null_support_tickets_satisfaction_score": 1112,
        "not_null_fact_ai_usage_ai_model_key": 200,
        "not_null_int_ai_usage_metrics_output_tokens": 910,
        "relationships_fact_ai_usage_subscription_key": 0,
        "relationships_fact_ai_usage_customer_key": 3334,
        "unique_payments_payment_id": 0,
    }
    checks = [c for c in all_checks() if c.check_id in want]
    got = {r.check_id: r.failures for r in Q.run_checks(ms.__getitem__, checks).collect()}
    assert got == want


def test_enforce_raises_on_failure(spark, ms):
    checks = [c for c in all_checks() if c.check_id == "not_null_support_tickets_closed_at"]
    with pytest.raises(Q.DataQualityError):
        Q.enforce(Q.run_checks(ms.__getitem__, checks))
    ok = [c for c in all_checks() if c.check_id == "unique_accounts_account_id"]
    assert Q.enforce(Q.run_checks(ms.__getitem__, ok))[0]["failures"] == 0


def test_selection():
    assert PM.select("staging") == ["stg_accounts", "stg_subscriptions", "stg_payments",
                                    "stg_support_tickets", "stg_ai_usage_events"]
    assert PM.select("fact_payments+") == ["fact_payments", "dim_date"]
    up = PM.select("+dim_date")
    assert up[-1] == "dim_date" and "stg_payments" in up and "fact_ai_usage" in up
    with pytest.raises(KeyError):
        PM.select("nope")


def _landed(spark):
    root = run_dir(spark, "landing-test")
    L.write_landing(spark, SF0001, root, "2026-10-02", 2026, 9)
    return root


def test_pipeline_fails_closed_on_seeded_violations(spark):
    root = _landed(spark)
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, root, run_dir(spark, "wh"), as_of="2026-10-02")
    assert e.value.stage == "test" and isinstance(e.value.cause, Q.DataQualityError)


def test_pipeline_gate_stops_before_load(spark, scratch):
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, scratch, run_dir(spark, "wh"))
    assert e.value.stage == "gate"


def test_pipeline_selection_warn_mode(spark):
    root = _landed(spark)
    res = run_pipeline(spark, root, run_dir(spark, "wh"), as_of="2026-10-02",
                       selection="fact_payments+", on_check_failure="warn",
                       ingested_at="2026-10-02 00:00:00")
    built = {name: layer for name, (layer, _) in res.built.items()}
    assert built["fact_payments"] == "marts" and built["dim_date"] == "marts"
    assert "int_customer_360" not in built
    summary = {r.table_name: r.rows for r in res.summary().collect()}
    assert summary["fact_payments"] == summary["payments"] == 6000
    stored = spark.table("marts.fact_payments")     # along day and customer: tests/test_clustering.py
    assert stored.columns == res.built["fact_payments"][1].columns and stored.select("payment_key").distinct().count() == 6000
    ids = {r["check_id"] for r in res.check_rows}
    assert "unique_fact_payments_payment_key" in ids
    assert "relationships_fact_payments_customer_key" not in ids   # dim_customer not built


def test_pipeline_incremental_rerun_adds_nothing(spark):
    root = _landed(spark)
    wh = run_dir(spark, "wh")
    kw = dict(as_of="2026-10-02", selection="staging", on_check_failure="warn",
              ingested_at="2026-10-02 00:00:00", incremental=True)
    first = run_pipeline(spark, root, wh, **kw)
    assert first.appended == {"accounts": 160, "subscriptions": 1500, "payments": 6000,
                              "support_tickets": 1000, "ai_usage_events": 1000}
    second = run_pipeline(spark, root, wh, **kw)
    assert set(second.appended.values()) == {0}
    rows = {r.table_name: r.rows for r in second.summary().collect()}
    assert rows["payments"] == 6000 and rows["stg_ai_usage_events"] == 1000
    # relations are addressable through the catalog namespaces
    assert spark.table("raw.payments").count() == spark.table("staging.stg_payments").count() == 6000
    assert {"raw", "staging", "intermediate", "marts"} <= {r.namespace for r in spark.sql("SHOW DATABASES").collect()}


def _csv_files(root):
    import os
    return [os.path.join(r, f) for r, _, fs in os.walk(root.removeprefix("file:")) for f in fs if f.endswith((".csv", ".txt"))]


def test_archive_is_the_last_step(spark):
    """A failed test run archives nothing; a passing one moves what it loaded;
    later files are loaded and moved by the next run."""
    root, wh, archive = _landed(spark), run_dir(spark, "wh"), run_dir(spark, "archive")
    n = len(_csv_files(root))
    kw = dict(as_of="2026-10-02", selection="staging", incremental=True, archive_dir=archive)
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, root, wh, **kw)
    assert e.value.stage == "test" and len(_csv_files(root)) == n and not _csv_files(archive)
    res = run_pipeline(spark, root, wh, on_check_failure="warn", **kw)
    assert not _csv_files(root) and len(_csv_files(archive)) == n == sum(res.archived.values())
    assert any("accounts/ingestion_date=2026-10-02/" in f for f in _csv_files(archive))
    assert spark.table("raw.payments").count() == 6000
    with pytest.raises(ValueError):
        run_pipeline(spark, root, wh, archive_dir=archive)


def test_failed_rebuild_keeps_the_last_good_table(spark):
    from ledgerloom.plans.catalog import Catalog
    cat = Catalog(spark, run_dir(spark, "wh"))
    cat.write_table("marts", "kept", spark.range(5))
    with pytest.raises(Exception):
        cat.write_table("marts", "kept", spark.range(7).select((F.col("id") / F.lit(0)).cast("long").alias("id"),))
    assert spark.table("marts.kept").count() == 5
    for n in (3, 4, 2):
        cat.write_table("marts", "kept", spark.range(n))
    assert spark.table("marts.kept").count() == 2
    assert len(cat._versions(cat.location("marts", "kept"))) <= 3
    cat.write_table("marts", "kept", spark.range(2).selectExpr("cast(id as string) s"))     # other columns
    assert spark.table("marts.kept").columns == ["s"]


def test_clean_runs_removes_old_runs_only(spark, scratch):
    import os
    from ledgerloom.session import clean_runs
    run = os.path.basename(run_dir(spark, "dq"))
    names = [run, run[:-12] + "a" * 12, "6f0c2f0e-8a52-4a52-9d52-0123456789ab", "other"]
    for n in names:
        os.mkdir(os.path.join(scratch, n))
        if n != run:
            os.utime(os.path.join(scratch, n), (1, 1))
    assert clean_runs(spark, 1, scratch) == 1
    assert sorted(os.listdir(scratch)) == sorted([names[0], *names[2:]])


def test_averages_are_not_rounded_and_hold_large_numbers(spark):
    from ledgerloom.functions.variant import avg_exact
    df = spark.createDataFrame([(20_000_000_000,), (20_000_000_001,), (20_000_000_001,)], "n long")
    assert str(df.agg(avg_exact(F.col("n"))).first()[0]).startswith("20000000000.66666666666")


def test_salted_join_equals_plain_join_on_hot_key(spark):
    from ledgerloom.operators.joins import salted_left_join
    ms = model_set(spark, SF0001)
    # a third of the subscriptions moved onto one account (derived from the driver tables)
    subs = ms["stg_subscriptions"].withColumn(
        "account_id", F.when(F.xxhash64("subscription_id") % 3 == 0, F.lit("A-1")).otherwise(F.col("account_id")))
    per_acc = ms["stg_support_tickets"].groupBy("account_id").agg(F.count(F.lit(1)).alias("tickets"))
    want = subs.join(per_acc, "account_id", "left")
    got = salted_left_join(subs, per_acc, "account_id", spread_by="subscription_id")
    assert got.columns == want.columns and got.count() == want.count() == subs.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_salted_join_null_keys(spark):
    from ledgerloom.operators.joins import salted_left_join
    base = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, v int")
    side = spark.createDataFrame([("a", 10), ("c", 30)], "k string, w int")
    got = sorted((r.v, r.k, r.w) for r in salted_left_join(base, side, "k", spread_by="v", salts=3).collect())
    assert got == [(1, None, None), (2, None, None), (3, "a", 10), (4, "b", None)]


@pytest.mark.parametrize("sf", [SF0001, SF001, "/root/testdata/sf0.1"])
def test_raw_tables_keep_every_row_and_models_scan_once(spark, sf):
    ms = model_set(spark, sf)
    n = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("customer", "supplier", "orders", "lineitem", "events")}
    got = {t: ms[t].count() for t in PM.RAW}
    assert got == {"accounts": n["customer"] + n["supplier"], "subscriptions": n["orders"], "payments": n["lineitem"],
                   "support_tickets": n["events"], "ai_usage_events": n["events"]}
    plan = ms["int_customer_360"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and plan.count("events.parquet") == 1


def test_full_report_sf001_only_seeded_checks_fail(spark):
    """All 153 checks at sf0.01: exactly the seeded violations fail, the
    other 146 report 0 (the clean case)."""
    import __spark_entry__ as E
    rows = {r.check_id: r for r in E.queries()["dq_report"](spark, SF001).collect()}
    assert len(rows) == 153
    failing = {cid: r.failures for cid, r in rows.items() if r.failures}
    assert failing == {
        "not_null_fact_ai_usage_ai_model_key": 200,
        "not_null_int_ai_usage_metrics_model_name": 200,
        "not_null_int_ai_usage_metrics_output_tokens": 910,
        "not_null_subscriptions_seats": 155,
        "not_null_support_tickets_closed_at": 2000,
        "not_null_support_tickets_satisfaction_score": 1112,
        "relationships_fact_ai_usage_customer_key": 3334,
    }
    assert all(r.status == ("fail" if r.failures else "pass") for r in rows.values())


def test_report_plan_stays_small(spark):
    """Half the scans of the first version (82), and no catalog tables joined in."""
    import __spark_entry__ as E
    plan = E.queries()["dq_report"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 41
    assert "Join" not in plan and "LocalTableScan" not in plan


def test_check_semantics_on_hand_made_rows(spark):
    import datetime as dt
    from ledgerloom.operators.checks import Check
    child = spark.createDataFrame(
        [("a", "Gold", True, dt.date(2026, 1, 1), 5), ("a", "Gold", None, dt.date(2026, 1, 2), -1),
         ("b", "Silver", False, dt.date(2026, 1, 9), None), (None, "Starter", True, None, 0),
         ("c", None, True, dt.date(2026, 1, 1), 3)],
        "k string, tier string, flag boolean, d date, n int")
    parent = spark.createDataFrame([("a", dt.date(2026, 1, 1)), ("a", dt.date(2026, 1, 2))],
                                   "k string, d date")
    rel = {"child": child, "parent": parent}
    checks = [
        Check("u_k", "t", "child", "k", "unique", None),                  # 'a' twice; NULL ignored
        Check("u_d", "t", "child", "d", "unique", None),                  # 2026-01-01 twice
        Check("nn_k", "t", "child", "k", "not_null", None),
        Check("av_tier", "t", "child", "tier", "accepted_values", ("Starter",)),   # Gold, Silver
        Check("av_flag", "t", "child", "flag", "accepted_values", (True, False)),
        Check("rel_k", "t", "child", "k", "relationships", ("parent", "k")),      # b, c rows
        Check("rel_d", "t", "child", "d", "relationships", ("parent", "d")),      # 2026-01-09
        Check("ge0_n", "t", "child", "n", "expression_is_true", ">= 0"),          # -1; NULL passes
    ]
    got = {r.check_id: r.failures for r in Q.run_checks(rel.__getitem__, checks).collect()}
    assert got == {"u_k": 1, "u_d": 1, "nn_k": 1, "av_tier": 2, "av_flag": 0,
                   "rel_k": 2, "rel_d": 1, "ge0_n": 1}


def test_cli_land_and_run(spark, capsys):
    from ledgerloom.__main__ import main
    root = run_dir(spark, "cli")
    landing = f"{root}/landing"
    assert main(["land", "--sf-dir", SF0001, "--landing", landing, "--ingestion-date", "2026-10-02",
                 "--year", "2026", "--month", "9"]) == 0
    assert main(["run", "--landing", landing, "--warehouse", f"{root}/wh1", "--as-of", "2026-10-02",
                 "--select", "staging", "--warn"]) == 0
    assert "checks" in capsys.readouterr().out
    # fail closed on the seeded violations
    assert main(["run", "--landing", landing, "--warehouse", f"{root}/wh2", "--as-of", "2026-10-02"]) == 1
