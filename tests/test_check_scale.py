"""What the checks move at size."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import extra_queries
from ledgerloom.operators import quality as Q
from ledgerloom.operators.checks import Check, all_checks
from ledgerloom.plans import models as M
from tests.conftest import SF0001


def check(model, column, test, arg=None):
    return Check(f"{test}_{model}_{column}", "source", model, column, test, arg)


def failures(rel, checks):
    return {r.check_id: r.failures for r in Q.run_checks(rel.__getitem__, checks).collect()}


@pytest.fixture()
def related(spark):
    parent = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "id string, n int")
    child = spark.createDataFrame([("x", "a", True), ("y", "c", False), ("y", "c", None), ("y", "d", True), ("z", None, True), (None, "b", True)],
                                  "id string, parent string, flag boolean")
    other = spark.createDataFrame([("c",), ("a",), ("a",)], "parent string")
    return {"parent": parent, "child": child, "other": other}


CHECKS = [check("parent", "id", "unique"), check("child", "id", "unique"), check("other", "parent", "unique"),
          check("child", "parent", "relationships", ("parent", "id")), check("other", "parent", "relationships", ("parent", "id")),
          check("child", "flag", "accepted_values", (True,)), check("child", "parent", "accepted_values", ("a", "b", "c"))]
FAILURES = [1, 1, 1, 3, 1, 1, 1]


def test_keys_of_a_space_are_counted_by_one_aggregate(spark, related):
    assert failures(related, CHECKS) == {c.check_id: n for c, n in zip(CHECKS, FAILURES)}
    numbered = list(enumerate(CHECKS))
    slots = Q.key_slots(numbered)
    assert slots == {Q.PARENTS: {("parent", "id"): 0, ("child", "parent"): 1, ("other", "parent"): 2}}
    plan = Q.key_failures(related.__getitem__, [x for x in numbered if x[1].column == "parent" or x[1].model == "parent"],
                          slots)._jdf.queryExecution().toString()
    assert "collect_list" not in plan and plan.split("== Physical Plan ==")[1].count("hashpartitioning(") == 2     # keys, then check numbers


@pytest.mark.parametrize("hashed", [lambda k: F.lit(7).cast("bigint"), lambda k: F.length(k).cast("bigint"), Q._hash])
def test_keys_that_share_a_hash_are_told_apart(spark, related, monkeypatch, hashed):
    monkeypatch.setattr(Q, "_hash", hashed)
    uniques = [c for c in CHECKS if c.test == "unique"]
    assert failures(related, uniques) == dict.fromkeys([c.check_id for c in uniques], 1)
    sound = {"s": spark.range(50).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("id"))}
    assert failures(sound, [check("s", "id", "unique")]) == {"unique_s_id": 0}


def test_only_hashes_of_lone_unique_keys_are_shuffled(spark, related, scratch, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "run_dir", lambda spark, name: seen.append(os.path.join(scratch, f"{len(seen)}")) or seen[-1])
    assert Q.unique_failures(related.__getitem__, [(0, check("parent", "n", "unique"))]) is None
    found = Q.unique_failures(related.__getitem__, [(0, check("parent", "n", "unique")), (5, check("child", "id", "unique"))])
    assert [tuple(r) for r in found.collect()] == [(5, 1)]
    assert [spark.read.parquet(p).columns for p in seen] == [["no", "h"]] * 2 and spark.read.parquet(seen[1]).count() == 1


@pytest.mark.parametrize("tests", [("not_null",), ("unique",), ("relationships",), None])
def test_checks_store_no_joined_view(spark, scratch, monkeypatch, tests):
    path = os.path.join(scratch, "dq")
    monkeypatch.setattr(extra_queries, "run_dir", lambda spark, name: path)
    extra_queries._checked(spark, SF0001, all_checks(tests=tests)).count()
    assert set(os.listdir(path)) == {"accounts", "payments", "stg_ai_usage_events", "dim_date"} == set(M.REUSE_STORE)


def test_keys_of_a_joined_view_need_no_facts(spark, scratch):
    ms = extra_queries._ms(spark, SF0001)
    ms.store(spark, ["int_customer_360", "int_account_revenue"], scratch)
    for name in ("int_customer_360", "int_account_revenue"):
        plan = ms[name].select("account_id")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan


def test_unique_checks_of_one_stored_column_share_its_shuffle(spark, scratch):
    spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "id string").write.parquet(scratch + "/t")
    raw = spark.read.parquet(scratch + "/t")
    views = {"raw": raw, "mart": raw.select("*").select(F.col("id").alias("key"), "id")}
    checks = [(0, check("raw", "id", "unique")), (1, check("mart", "key", "unique")), (2, check("mart", "id", "unique"))]
    hashes = Q.repeated_hashes(views.__getitem__, checks)
    assert sorted(r.no for r in hashes.collect()) == [0, 1, 2]
    assert hashes._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("ReusedExchange") == 2
    assert failures(views, [c for _, c in checks]) == {"unique_raw_id": 1, "unique_mart_key": 1, "unique_mart_id": 1}


@pytest.mark.parametrize("tests, columns", [
    (("unique",), ["payment_date", "payment_id"]), (("relationships",), ["account_id", "payment_date", "subscription_id"]),
    (None, ["payment_id", "account_id", "subscription_id", "payment_date", "amount", "currency", "payment_status", "payment_method"])])
def test_payments_are_stored_with_the_columns_checks_read(spark, scratch, monkeypatch, tests, columns):
    path = os.path.join(scratch, "dq")
    monkeypatch.setattr(extra_queries, "run_dir", lambda spark, name: path)
    extra_queries._checked(spark, SF0001, all_checks(tests=tests)).count()
    assert spark.read.parquet(path + "/payments").columns == columns


def test_a_column_that_was_not_stored_cannot_be_read(spark, scratch):
    ms = extra_queries._ms(spark, SF0001)
    whole = ms["fact_payments"].select("payment_key", "date_key").collect()
    ms.store(spark, ["fact_payments"], scratch, columns={"payments": M.reads_of_payments({("fact_payments", "payment_key")})})
    assert sorted(ms["fact_payments"].select("payment_key", "date_key").collect()) == sorted(whole)
    with pytest.raises(Exception, match="payments.amount was not stored"):
        ms["fact_payments"].select("amount").collect()


def test_dates_of_line_items_are_cut_before_the_join(spark):
    plan = extra_queries._ms(spark, SF0001)["payments"].select("payment_date", "account_id")._jdf.queryExecution().optimizedPlan().toString()
    join, sides = plan.split("Join", 1)
    assert "cast(l_shipdate" in sides and "cast(l_shipdate" not in join


def values(df, column):
    return sorted(str(r[0]) for r in df.select(column).collect())


def test_declared_copies_are_row_for_row(spark):
    ms = extra_queries._ms(spark, SF0001)
    for model, columns in M.COPIES.items():
        for column, (up, source) in columns.items():
            assert up in M.upstream(model) and values(ms[model], column) == values(ms[up], source), (model, column)


def test_a_stored_column_is_a_key_column_once(spark, scratch, monkeypatch):
    """Copies of a column in other views take no rows of the shuffle of keys."""
    monkeypatch.setattr(extra_queries, "run_dir", lambda spark, name: scratch + "/dq")
    seen = []
    monkeypatch.setattr(Q, "key_failures", lambda resolve, numbered, slots, f=Q.key_failures: seen.append(slots) or f(resolve, numbered, slots))
    checks = all_checks(tests=("relationships", "unique"))
    found = {r.check_id: r.failures for r in extra_queries._checked(spark, SF0001, checks).collect()}
    columns = [at for space in seen[0].values() for at in space]
    assert len(columns) == len(set(columns)) == 16
    assert {m for m, _ in columns} == {"accounts", "subscriptions", "payments", "support_tickets", "stg_ai_usage_events", "fact_payments",
                                       "fact_support_tickets", "fact_ai_usage", "dim_date", "dim_ai_model", "dim_feature"}
    ms = extra_queries._ms(spark, SF0001)
    assert found == failures(ms, checks)                        # every view counted by itself
    assert any(n for n in found.values())


def test_a_view_that_gains_rows_or_was_given_is_counted_itself(spark, monkeypatch):
    ms = extra_queries._ms(spark, SF0001)
    assert ms.origin("int_customer_360", "account_id") == ms.origin("dim_customer", "customer_key") == ("accounts", "account_id")
    assert ms.origin("dim_customer", "plan_tier") == ("dim_customer", "plan_tier")
    ms.override("dim_customer", ms["dim_customer"].limit(3))
    assert ms.origin("dim_customer", "customer_key") == ("dim_customer", "customer_key")
    whole = M.MODELS["int_customer_360"]
    twice = M.Model(whole.name, whole.layer, whole.materialized, lambda *a, **k: (lambda v: v.unionAll(v))(whole.build(*a, **k)), whole.upstream)
    monkeypatch.setitem(M.MODELS, "int_customer_360", twice)
    ms = extra_queries._ms(spark, SF0001)
    assert ms.origin("int_customer_360", "account_id") == ("int_customer_360", "account_id")
    checks = [c for c in all_checks(tests=("unique",)) if c.model == "int_customer_360"]
    assert [r.failures for r in Q.run_checks(ms.__getitem__, checks, ms.origin).collect()] == [ms["accounts"].count()]


def test_counting_a_joined_view_runs_no_join(spark):
    ms = extra_queries._ms(spark, SF0001)
    for name in M.JOINED_ONTO:
        plan = ms[name].groupBy().count()._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftOuter" not in plan, plan
