"""What the pipeline keeps on disk: landed text, stored rows, shuffles."""

import glob
import gzip
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom import extra_queries as X
from ledgerloom.operators import clustering as C
from ledgerloom.operators.checks import all_checks
from ledgerloom.operators.quality import at_origin
from ledgerloom.plans import pipeline as P
from ledgerloom.plans.models import MODELS
from ledgerloom.schemas import CSV_TABLES
from ledgerloom.session import run_dir, shuffles_dropped
from ledgerloom.sources import landing as L
from tests.conftest import SF0001


def _files(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root.removeprefix("file:")) for f in names if not f.startswith((".", "_"))]


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle_")}


def test_compressed_landing_has_bounded_files_and_the_same_records(spark, scratch, monkeypatch):
    monkeypatch.setattr(L, "COMPRESSED_RECORDS", 700)
    plain, packed = f"{scratch}/plain", f"{scratch}/packed"
    L.write_landing(spark, SF0001, plain, "2026-10-02", 2026, 9)
    L.write_landing(spark, SF0001, packed, "2026-10-02", 2026, 9, compression="gzip")
    files = _files(packed)
    assert files and all(f.endswith((".csv.gz", ".txt.gz")) for f in files)
    size = lambda root: sum(map(os.path.getsize, _files(root)))      # noqa: E731
    assert size(packed) < size(plain) / 2
    for f in files:
        with gzip.open(f, "rt") as text:
            assert sum(1 for _ in text) - f.endswith(".csv.gz") <= 700, f
    for multiline in (False, True):
        a, b = (L.load_all(spark, root, "2026-10-02 00:00:00", multiline) for root in (plain, packed))
        for name in CSV_TABLES:
            assert a[name].count() == b[name].count() > 0 and a[name].exceptAll(b[name]).isEmpty(), name
    events = [df["ai_usage_events"].select(F.to_json("raw_event")) for df in (a, b)]
    assert events[0].count() == events[1].count() == 1000 and events[0].exceptAll(events[1]).isEmpty()


def test_the_pipeline_lands_compressed_text_and_stores_zstd(spark, monkeypatch):
    root, wh = X._landed(spark, SF0001), run_dir(spark, "wh")
    assert all(f.endswith(".gz") for f in _files(root))
    run, calls = P.run_concurrently, []
    monkeypatch.setattr(P, "run_concurrently", lambda tasks, threads: (calls.append((list(tasks), threads)), run(tasks, threads))[1])
    monkeypatch.setattr(P, "ONE_BY_ONE", 11_000)       # the ledger's rows: 160 + 1,500 + 6,000 + 1,000 + 1,000
    P.run_pipeline(spark, root, wh, as_of="2026-10-02", selection="dim_customer", on_check_failure="warn")
    assert [n for _, n in calls[1:]] == [4]
    calls.clear()
    monkeypatch.setattr(P, "ONE_BY_ONE", 9_000)
    P.run_pipeline(spark, root, wh, as_of="2026-10-02", selection="marts", on_check_failure="warn")
    assert all(n == 1 for _, n in calls[1:]) and set(calls[1][0][:3]) == set(P.CLUSTERED)       # facts first, one by one
    stored = [f for f in _files(wh) if f.endswith(".parquet") and ("/rows/" in f or "/marts/" in f)]
    used = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in stored if pq.ParquetFile(f).metadata.num_row_groups}
    assert len(stored) > 10 and used == {"ZSTD"}


def test_shuffle_files_go_with_their_query(spark):
    before, was = _shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")

    def query():
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.format("noop").mode("overwrite").save()

    query()
    kept = _shuffle_files(spark) - before
    assert kept                         # without it they stay
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        for _ in range(3):
            query()
        1 / 0
    for _ in range(50):                 # removed in the background
        if not _shuffle_files(spark) - before - kept:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before - kept
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == was


@pytest.mark.parametrize("name", sorted(P.CLUSTERED))
def test_facts_are_made_after_the_shuffle(spark, name):
    """Only the staging relation's columns are shuffled; the fact's rows are the same."""
    from ledgerloom.registry import model_set
    ms = model_set(spark, SF0001)
    staging, fact = ms[MODELS[name].upstream[0]], ms[name]
    got = MODELS[name].build(C.clustered(staging, *P.CLUSTERED[name]))
    assert got.schema == fact.schema and got.count() == fact.count() > 0
    assert got.exceptAll(fact).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RepartitionByExpression")
    key = fact.columns[0]
    assert f"AS {key}#" in above and f"AS {key}#" not in below


def test_facts_of_many_rows_get_more_partitions(spark, scratch, monkeypatch):
    monkeypatch.setattr(C, "PARTITION_ROWS", 100)
    rows = spark.range(2000).selectExpr("id", "id % 50 AS customer", "date_add(DATE'2026-01-01', CAST(id % 90 AS INT)) AS day")
    for partitions, files in (("4", 20), ("64", None)):         # 64: enough, sizes decide
        spark_before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            C.clustered(rows, ("day", "customer"), "id").write.parquet(f"{scratch}/{partitions}")
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", spark_before)
        found = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{scratch}/{partitions}/*.parquet")]
        assert sum(found) == 2000
        assert files is None or (files - 4 <= len(found) <= files and max(found) <= 300)


def test_keys_of_a_passed_on_view_are_counted_with_its_table(spark):
    checks = [at_origin(c, P._stored) for c in all_checks()]
    assert {c.arg[0] for c in checks if c.test == "relationships"} == {
        "accounts", "subscriptions", "dim_customer", "dim_subscription", "dim_date", "dim_ai_model", "dim_feature"}
