"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for NTZ/LTZ conversions, ANSI casts so a
# bad value aborts a load (the reference's ON_ERROR = ABORT_STATEMENT), AQE for
# runtime partition coalescing, skew splitting and broadcast decisions made on
# measured (not estimated) sizes.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "ledgerloom", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A session with ``CORE_CONF``. Master, memory and partitions are the
    submitter's business; a local master (tests, bench) gets settings for one
    machine."""
    b = SparkSession.builder.appName(app)
    conf = {**CORE_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if master:
        b = b.master(master)
    if (master or "").startswith("local"):
        conf |= {"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": "8"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Runtime-settable part of ``CORE_CONF`` for a session someone else built.

    The session time zone is left as the caller set it: every timestamp the
    queries produce is TIMESTAMP_NTZ, and the current time is converted to UTC
    where it is read (``functions.variant.utc_now``)."""
    for k, v in CORE_CONF.items():
        if k == "spark.sql.session.timeZone":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - some confs are static on some builds
            pass


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Within it a query's shuffle files go as soon as the query has ended. Else
    they stay until the driver happens to collect its garbage, and a job of many
    queries holds the shuffles of all of them on disk at once. For writes and other
    queries that end with their call: a frame that is cached, read by an iterator or
    collected twice needs its shuffles for longer."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``, or the one given
    to ``setCheckpointDir``).

    Where it is unset, a session with a local master gets a folder of its own,
    set as its checkpoint dir; on a cluster an unset value is an error, never a
    machine-local folder.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


RUN_PREFIX = "ledgerloom-run-"


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one run."""
    path = os.path.join(shared_dir(spark), f"{RUN_PREFIX}{name}-{uuid.uuid4().hex[:12]}")
    return path


def clean_runs(spark: SparkSession, older_than_hours: float = 24.0, folder: str | None = None) -> int:
    """Retention: remove the folders that ``run_dir`` made in the shared folder
    and that were not touched for so long. Each run owns its folder, so nothing
    else reads it once the run's results have been used. Returns how many went."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder or shared_dir(spark))
    fs, gone = p.getFileSystem(spark._jsc.hadoopConfiguration()), 0
    before = spark._jvm.java.lang.System.currentTimeMillis() - int(older_than_hours * 3_600_000)
    for x in fs.listStatus(p) if fs.exists(p) else ():
        if re.fullmatch(RUN_PREFIX + "[a-z0-9_-]+-[0-9a-f]{12}", x.getPath().getName()) and x.getModificationTime() < before:
            gone += bool(fs.delete(x.getPath(), True))
    return gone
