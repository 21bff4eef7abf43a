"""Ledgered loads (all or nothing, resumable, content-aware, archive) and
publishing through snapshots."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import pipeline as P
from ledgerloom.plans.pipeline import PipelineError, run_pipeline
from ledgerloom.plans.snapshots import SnapshotConflict, Snapshots
from ledgerloom.schemas import LANDING_PREFIX
from ledgerloom.sources.ledger import COMPACT_AT, ChangedFiles, Loader
from tests.test_loaders import HEADER

PREFIX = "postgres/accounts"


def line(i, name="n", trial="true"):
    return f"A-{i},{name},i,c,2026-01-02,r,Starter,3,{trial},false\n"


def put(root, name, *lines, at=None, prefix=PREFIX, header=HEADER):
    path = os.path.join(root, prefix, "ingestion_date=2026-10-02", name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(header + "".join(lines))
    if at is not None:
        os.utime(path, (at, at))
    return path


@pytest.fixture()
def lake(spark, scratch):
    return os.path.join(scratch, "landing"), Snapshots(spark, os.path.join(scratch, "wh"))


def load(spark, snapshots, landing, append=True, **kw):
    loader = Loader(spark, snapshots)
    staged = loader.stage("accounts", landing, append, **kw)
    loader.commit([staged], append)
    return staged


def ids(spark, snapshots):
    return sorted(r[0] for r in Loader(spark, snapshots).rows("accounts").select("account_id").collect())


def test_ledger_has_a_row_a_file_and_a_rerun_adds_nothing(spark, lake):
    landing, snapshots = lake
    put(landing, "a.csv", line(1), line(2)), put(landing, "b + c%20[1].csv", line(3)), put(landing, "empty.csv")
    first = load(spark, snapshots, landing)
    assert (first.rows, first.changed) == (3, []) and ids(spark, snapshots) == ["A-1", "A-2", "A-3"]
    ledger = {r.stage_path.rsplit("/", 1)[1]: r for r in Loader(spark, snapshots).ledger().collect()}
    assert {n: r.rows for n, r in ledger.items()} == {"a.csv": 2, "b + c%20[1].csv": 1, "empty.csv": 0}
    assert ledger["a.csv"].length == os.path.getsize(os.path.join(landing, PREFIX, "ingestion_date=2026-10-02/a.csv"))
    assert len({r.digest for r in ledger.values()}) == 3 and {r.source for r in ledger.values()} == {"accounts"}
    before = snapshots.head()["number"]
    again = load(spark, snapshots, landing)
    assert (again.rows, again.batches, snapshots.head()["number"]) == (0, [], before)
    put(landing, "d.csv", line(4))
    assert load(spark, snapshots, landing).rows == 1 and len(ids(spark, snapshots)) == 4


def test_same_name_with_new_content_is_reported(spark, lake):
    landing, snapshots = lake
    put(landing, "a.csv", line(1), line(2), at=1_000_000), put(landing, "b.csv", line(3), at=1_000_000)
    load(spark, snapshots, landing)
    put(landing, "a.csv", line(2), line(1), at=2_000_000)           # touched: the same records in another order
    put(landing, "b.csv", line(7), at=2_000_000)                    # the same size, another record
    again = load(spark, snapshots, landing)
    assert again.rows == 0 and [c.rsplit("/", 1)[1] for c in again.changed] == ["b.csv"]
    assert ids(spark, snapshots) == ["A-1", "A-2", "A-3"]
    with pytest.raises(ChangedFiles, match="b.csv"):
        load(spark, snapshots, landing, on_change="raise")
    put(landing, "b.csv", "broken,line\n", at=3_000_000)            # not even loadable: still reported only
    assert len(load(spark, snapshots, landing).changed) == 1


def test_load_is_all_or_nothing_and_resumes(spark, lake):
    landing, snapshots = lake
    put(landing, "0.csv", line(0))
    load(spark, snapshots, landing)
    put(landing, "1.csv", line(1)), put(landing, "2.csv", line(2)), put(landing, "3.csv", line(3, trial="perhaps"))
    with pytest.raises(Exception, match="perhaps"):
        load(spark, snapshots, landing, files_per_batch=1)
    assert ids(spark, snapshots) == ["A-0"] and Loader(spark, snapshots).ledger().count() == 1
    pending = Loader(spark, snapshots).pending("accounts")
    assert len(pending) == 2
    put(landing, "2.csv", line(22)), put(landing, "3.csv", line(3))     # one fixed, one pending file replaced meanwhile
    done = load(spark, snapshots, landing, files_per_batch=1)
    assert ids(spark, snapshots) == ["A-0", "A-1", "A-22", "A-3"] and done.rows == 3
    assert len(set(pending) & set(done.batches)) == 1               # the untouched batch was not read again
    assert Loader(spark, snapshots).pending("accounts") == []


def test_replace_loads_what_is_there(spark, lake):
    landing, snapshots = lake
    gone = put(landing, "a.csv", line(1))
    put(landing, "b.csv", line(2))
    load(spark, snapshots, landing, append=False)
    os.remove(gone)
    put(landing, "c.csv", line(3))
    assert load(spark, snapshots, landing, append=False).rows == 2
    assert ids(spark, snapshots) == ["A-2", "A-3"]
    shutil.rmtree(landing)
    assert load(spark, snapshots, landing).rows == 0 and ids(spark, snapshots) == ["A-2", "A-3"]


def test_many_small_loads_are_compacted(spark, lake, monkeypatch):
    from ledgerloom.sources import ledger
    assert COMPACT_AT > 3
    monkeypatch.setattr(ledger, "COMPACT_AT", 3)
    landing, snapshots = lake
    for i in range(5):
        put(landing, f"{i}.csv", line(i))
        load(spark, snapshots, landing)
    assert len(snapshots.head()["loaded"]["accounts"]["rows"]) <= 3
    assert ids(spark, snapshots) == [f"A-{i}" for i in range(5)] and Loader(spark, snapshots).ledger().count() == 5
    assert load(spark, snapshots, landing).rows == 0


def test_archive_moves_what_the_ledger_has(spark, lake, scratch):
    landing, snapshots = lake
    archive = os.path.join(scratch, "archive")
    put(landing, "a.csv", line(1)), put(landing, "b.csv", line(2), at=5_000)
    load(spark, snapshots, landing)
    late = put(landing, "late.csv", line(3), at=1_000)              # back-dated, came after the listing
    put(landing, "b.csv", line(22), at=6_000)                       # changed after it was loaded
    assert Loader(spark, snapshots).archive("accounts", landing, archive) == 1
    assert os.path.exists(os.path.join(archive, "ingestion_date=2026-10-02/a.csv"))
    assert os.path.exists(late) and len(os.listdir(os.path.dirname(late))) >= 2
    assert load(spark, snapshots, landing).rows == 1 and ids(spark, snapshots) == ["A-1", "A-2", "A-3"]
    assert Loader(spark, snapshots).archive("accounts", landing, archive) == 1 and not os.path.exists(late)


def test_only_one_of_two_writers_commits(spark, lake):
    _, snapshots = lake
    base = snapshots.head()
    assert base["number"] == 0 and snapshots.open().names() == []
    first = snapshots.commit(base, report={"path": "x", "failing": 0})
    with pytest.raises(SnapshotConflict):
        snapshots.commit(base, report={"path": "y", "failing": 0})
    with open(os.path.join(snapshots.home, f"{first['number'] + 1:010d}.json"), "w") as f:
        f.write('{"number": 2, "loa')                               # a writer that died
    assert snapshots.head() == first
    third = snapshots.commit(first, report=None)
    assert third["number"] == 3 and snapshots.head()["report"] is None


# --- the whole job -----------------------------------------------------------

def small_lake(root, day, accounts):
    """All five sources, a few rows each."""
    def into(source, text):
        path = os.path.join(root, LANDING_PREFIX[source], f"ingestion_date={day}", f"{day}.csv")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    into("accounts", HEADER + "".join(line(i) for i in accounts))
    into("subscriptions", "h\n" + "".join(f"S-{i},A-{i},2026-01-02,,Starter,3,10.00,120.00,false,false,false,false,Monthly,true\n" for i in accounts))
    into("payments", "h\n" + "".join(f"P-{i},A-{i},S-{i},2026-01-03,5.00,USD,Succeeded,ACH\n" for i in accounts))
    into("support_tickets", "h\n" + "".join(f"T-{i},A-{i},2026-01-04 10:00:00.000000,2026-01-05 10:00:00.000000,1.0,P1 - Critical,2.0,3.0,false\n" for i in accounts))
    into("ai_usage_events", "".join('{"event_id":"E-%d","account_id":"A-%d","subscription_id":"S-%d","event_timestamp":"2026-01-06 00:00:00",'
                                    '"model":"m","feature":"f","input_tokens":1,"output_tokens":2,"latency_ms":3,"status":"success"}\n' % (i, i, i)
                                    for i in accounts))


SELECTION = "staging dim_customer dim_subscription"
KW = dict(as_of="2026-10-02", incremental=True, selection=SELECTION)


def counts(snapshot):
    return {n.split(".")[1]: snapshot.table(n).count() for n in snapshot.names() if not n.endswith("data_test_results")}


def test_readers_see_one_published_set(spark, scratch, monkeypatch):
    landing, wh = os.path.join(scratch, "landing"), os.path.join(scratch, "wh")
    snapshots = Snapshots(spark, wh)
    small_lake(landing, "2026-10-02", [1, 2])
    run_pipeline(spark, landing, wh, **KW)
    first = snapshots.open()
    assert set(counts(first).values()) == {2} and len(counts(first)) == 12
    assert spark.table("marts.dim_customer").count() == spark.table("staging.stg_payments").count() == 2

    # a failing check: a subscription without its account, and a repeated account
    small_lake(landing, "2026-10-03", [2, 3])
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, landing, wh, **KW)
    assert e.value.stage == "test"
    assert counts(snapshots.open()) == counts(first)                # every reader: the old set, of all relations
    assert {spark.table(n).count() for n in ("raw.accounts", "staging.stg_accounts", "marts.dim_customer", "marts.dim_subscription")} == {2}
    head = snapshots.head()
    assert head["report"]["failing"] > 0 and spark.read.parquet(head["report"]["path"]).where("failures > 0").count() == head["report"]["failing"]
    assert Loader(spark, snapshots).ledger("accounts").count() == 2     # the load itself stays loaded
    dim = os.path.join(wh, "marts", "dim_customer")
    assert len(os.listdir(dim)) == 1                                # the failed candidate is gone

    # the run dies after publishing, while the catalog follows: readers of snapshots have the new set, whole
    real, calls = P.Catalog.register_folders, []

    def dying(self, layer, name, df, paths):
        calls.append(name)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(self, layer, name, df, paths)
    monkeypatch.setattr(P.Catalog, "register_folders", dying)
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, landing, wh, on_check_failure="warn", **KW)
    assert e.value.stage == "publish"
    assert set(counts(snapshots.open()).values()) == {4}
    assert set(counts(first).values()) == {2}                       # a reader that was open still reads its version
    monkeypatch.undo()

    # the next run repoints the catalog; old folders go once two newer sets are published
    for day in ("2026-10-04", "2026-10-05"):
        small_lake(landing, day, [int(day[-2:]) * 10])
        res = run_pipeline(spark, landing, wh, on_check_failure="warn", **KW)
        assert res.appended["accounts"] == 1
    assert set(counts(snapshots.open()).values()) == {6} and spark.table("marts.dim_customer").count() == 6
    assert spark.table("raw.accounts").count() == spark.table("staging.stg_accounts").count() == 6
    assert len(os.listdir(dim)) == 2 and len([f for f in os.listdir(snapshots.home) if f.endswith(".json")]) <= 5


def test_published_schema_and_empty_relations(spark, scratch):
    landing, wh = os.path.join(scratch, "landing"), os.path.join(scratch, "wh")
    small_lake(landing, "2026-10-02", [])
    run_pipeline(spark, landing, wh, as_of="2026-10-02", selection="staging dim_customer")
    snapshot = Snapshots(spark, wh).open()
    assert set(counts(snapshot).values()) == {0}
    assert snapshot.table("marts.dim_customer").columns == spark.table("marts.dim_customer").columns
    assert snapshot.table("raw.ai_usage_events").schema["raw_event"].dataType.simpleString() == "variant"


def test_entry_changes_its_kind(spark, scratch):
    from ledgerloom.plans.catalog import Catalog
    cat = Catalog(spark, os.path.join(scratch, "wh"))
    paths = []
    for n in (2, 3):
        path, df = cat.write_candidate("marts", "kinds", spark.range(n))
        paths.append(path)
    cat.register_folders("marts", "kinds", df, paths[:1])
    assert spark.table("marts.kinds").count() == 2
    cat.register_folders("marts", "kinds", df, paths)               # several folders: a view
    assert spark.table("marts.kinds").count() == 5
    cat.register_folders("marts", "kinds", df, paths[1:])
    assert spark.table("marts.kinds").count() == 3 and spark.table("marts.kinds").where(F.col("id") > 1).count() == 1
    cat.register_folders("marts", "kinds", df, [])
    assert spark.table("marts.kinds").count() == 0
