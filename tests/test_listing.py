"""The stage listing as a data source, against Spark's own file index."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import landing as L
from ledgerloom.sources.listing import Folder, StageFilesReader, list_files

FILES = ("postgres/accounts/ingestion_date=2026-10-01/part-0.csv", "postgres/accounts/ingestion_date=2026-10-02/part 1+é.csv",
         "external/payments/ingestion_date=2026-10-01/part-0.csv", "events/ai_usage/year=2026/month=08/a.txt",
         "events/ai_usage/year=2026/month=09/b.txt", "events/ai_usage/c.txt", "notes/readme.txt", "top.txt")
HIDDEN = ("postgres/accounts/_SUCCESS", "postgres/accounts/_temporary/0/part-0.csv", ".hidden/x.csv",
          "events/ai_usage/year=2026/month=09/_temporary/0/b.txt", "events/ai_usage/year=2026/month=09/.b.txt.crc")


@pytest.fixture()
def stage(scratch):
    for i, name in enumerate((*FILES, *HIDDEN)):
        path = os.path.join(scratch, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("x" * i)
        os.utime(path, (1_790_000_000 + i * 3600,) * 2)
    return scratch


@pytest.mark.parametrize("depth", [0, 1, 3, 9])
def test_listing_equals_the_file_index(spark, stage, depth):
    got = list_files(spark, stage, depth)
    want = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(stage)
            .select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"), "length", "modificationTime"))
    rows = {tuple(r) for r in got.select("path", "length", "modificationTime").collect()}
    assert len(rows) == got.count() == len(FILES)
    # Spark's reader has no rows for empty files
    assert {(os.path.basename(p), n, t) for p, n, t in rows if n} == {(os.path.basename(r.path), r.length, r.modificationTime)
                                                               for r in want.collect()}
    assert {r.stage_path for r in got.collect()} == {f if f.split("/")[0] in ("postgres", "external", "events") else ""
                                                     for f in FILES}


def test_each_folder_is_listed_by_a_task_of_its_own(spark, stage):
    parts = StageFilesReader(stage, 3).partitions()
    assert [p for p in parts if p.recursive] == [Folder(f"{stage}/{f}", True) for f in (
        "events/ai_usage/year=2026", "external/payments/ingestion_date=2026-10-01",
        "postgres/accounts/ingestion_date=2026-10-01", "postgres/accounts/ingestion_date=2026-10-02")]
    plan = list_files(spark, stage)._jdf.queryExecution().toString()
    assert "InMemoryFileIndex" not in plan and "stage_files" in plan


def test_filters_are_pushed(spark, stage):
    files = list_files(spark, stage)
    day = files.where(F.col("stage_path").startswith("postgres/accounts/ingestion_date=2026-10-02"))
    assert [r.length for r in day.collect()] == [1]
    reader = StageFilesReader(stage, 3)
    reader.starts = ["postgres/accounts/ingestion_date=2026-10-02/"]
    assert [p.path for p in reader.partitions() if p.recursive] == [f"{stage}/postgres/accounts/ingestion_date=2026-10-02"]
    at = dt.datetime.fromtimestamp(1_790_000_000 + 2 * 3600, dt.timezone.utc)
    late = files.where(F.col("modificationTime") > F.lit(at))
    assert {r.length for r in late.collect()} == {3, 4, 5, 6, 7}
    reader.after = at
    assert [i.size for i in reader._files(*_system(stage, "external/payments"))] == [2]
    assert [i.size for i in reader._files(*_system(stage, "postgres/accounts"))] == []


def _system(stage, folder):
    from pyarrow import fs
    return fs.LocalFileSystem(), Folder(f"{stage}/{folder}", True)


def test_empty_and_missing_roots(spark, scratch):
    assert list_files(spark, scratch).count() == 0
    with pytest.raises(Exception, match="(?i)cannot list|not found|no such"):
        list_files(spark, os.path.join(scratch, "nowhere")).count()


def test_folders_of_a_stage(spark, stage):
    got = {(r.source, r.folder): (r.has_files, r.has_bytes) for r in L.stage_folders(spark, stage).collect()}
    assert got[("accounts", "postgres/accounts/ingestion_date=2026-10-01")] == (True, False)
    assert set(got) == {("accounts", "postgres/accounts/ingestion_date=2026-10-01"),
                        ("accounts", "postgres/accounts/ingestion_date=2026-10-02"),
                        ("payments", "external/payments/ingestion_date=2026-10-01"),
                        ("ai_usage_events", "events/ai_usage/year=2026/month=08"),
                        ("ai_usage_events", "events/ai_usage/year=2026/month=09")}
