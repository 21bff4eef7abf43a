"""The pipeline job: gate → load → transform → test → publish → archive, in order.

Each stage raises on failure, so the run stops at the first broken stage
(``PipelineError`` names it). Loads are committed as a whole with their ledger.
Models are written as candidates that nobody reads, and the tests read the
candidates; only if they pass (or only warn) one manifest publishes all
relations at once. A failed test run leaves the published set as it was, keeps
the loaded files loaded, and records its report. Nothing is archived before
publishing. Candidates are read back from storage, which cuts lineage: an
executor lost during the checks never triggers a recompute of the loads.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import quality as Q
from ledgerloom.operators.clustering import clustered
from ledgerloom.plans.catalog import Catalog
from ledgerloom.plans.models import MODELS, RAW, ModelSet, select
from ledgerloom.plans.parallel import run_concurrently
from ledgerloom.plans.snapshots import Snapshots, drop_folder
from ledgerloom.session import shuffles_dropped
from ledgerloom.sources import landing as L
from ledgerloom.sources.ledger import Loader

# Staging models that only pass a raw table's columns on: kept as views over it.
# Every other model is stored: it parses JSON or aggregates, and the checks and
# the marts read it several times.
PASSED_ON = {"stg_accounts": "accounts", "stg_subscriptions": "subscriptions", "stg_payments": "payments",
             "stg_support_tickets": "support_tickets"}

# Facts are stored along a curve over their day and customer (and key, so that one
# place can fill many files): queries by either skip most files and row groups.
# A fact is a projection of one staging relation, row for row: that one's rows are
# put in order, by what the keys are made of, and the copies of keys and the flags
# are made after the shuffle.
CLUSTERED = {"fact_ai_usage": (("CAST(event_timestamp AS DATE)", "account_id"), "event_id"),
             "fact_payments": (("CAST(payment_date AS DATE)", "account_id"), "payment_id"),
             "fact_support_tickets": (("CAST(submitted_at AS DATE)", "account_id"), "ticket_id")}

# Loaded rows from which on a write keeps all cores busy by itself: then models are
# written one after another, so that the shuffles of one are on disk at a time.
ONE_BY_ONE = 20_000_000


class PipelineError(RuntimeError):
    def __init__(self, stage: str, cause: Exception):
        self.stage = stage
        self.cause = cause
        super().__init__(f"pipeline failed at stage '{stage}': {cause}")


@dataclass
class PipelineResult:
    built: dict[str, tuple[str, DataFrame]] = field(default_factory=dict)   # name → (layer, df)
    check_report: DataFrame | None = None
    check_rows: list[dict] = field(default_factory=list)
    appended: dict[str, int] = field(default_factory=dict)   # incremental loads: rows added
    archived: dict[str, int] = field(default_factory=dict)   # files moved after the tests
    changed: dict[str, list[str]] = field(default_factory=dict)   # loaded files that have other content now
    stage_seconds: dict[str, float] = field(default_factory=dict)

    def summary(self) -> DataFrame:
        """One row per built relation (layer, table_name, rows) plus one row
        with the number of failing data tests."""
        parts = [df.agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows")
                 for name, (layer, df) in self.built.items()]
        if self.check_report is not None:
            parts.append(self.check_report.agg(F.count_if(F.col("failures") > 0).alias("rows"))
                         .select(F.lit("tests").alias("layer"), F.lit("failing_checks").alias("table_name"),
                                 "rows"))
        return reduce(DataFrame.unionByName, parts)


def _stage(name: str, fn, *args, timings: dict | None = None, **kw):
    t0 = time.perf_counter()
    try:
        return fn(*args, **kw)
    except Exception as e:  # noqa: BLE001 - re-raised with the stage name
        raise PipelineError(name, e) from e
    finally:
        if timings is not None:
            timings[name] = round(time.perf_counter() - t0, 3)


def _load(loader: Loader, landing_root: str, append: bool, ingested_at, csv_multiline: bool, on_change: str,
          result: PipelineResult, threads: int) -> dict:
    """All sources staged, then committed together: new files, or all of them.
    Returns what is loaded now."""
    staged = run_concurrently({name: (lambda n=name: loader.stage(n, landing_root, append, ingested_at, csv_multiline, on_change))
                               for name in RAW}, threads)
    manifest = loader.commit([staged[name] for name in RAW], append)
    for name in RAW:
        result.changed[name] = staged[name].changed
        if append:
            result.appended[name] = staged[name].rows
    return manifest


def _publish(cat: Catalog, snapshots: Snapshots, candidates: dict[str, tuple[str, DataFrame, list[str]]], report: dict) -> None:
    """One manifest switches all relations; then the catalog's entries follow.
    Readers who need several relations of one version open a snapshot."""
    base = snapshots.head()
    relations = {f"{cat.namespace(layer)}.{name}": {"paths": paths, "schema": df.schema.jsonValue()}
                 for name, (layer, df, paths) in candidates.items()}
    snapshots.commit(base, published={**base["published"], **relations}, report=report)
    for name, (layer, df, paths) in candidates.items():
        if name in PASSED_ON:
            cat.register_view(layer, name, f"{cat.namespace('raw')}.{PASSED_ON[name]}", df)
        else:
            cat.register_folders(layer, name, df, paths)
    snapshots.forget()


def _stored(model: str, column: str) -> tuple[str, str]:
    """Where a column's rows are stored: a staging view over a raw table has none
    of its own, so its keys are the table's."""
    return PASSED_ON.get(model, model), column


def _levels(names: list[str]) -> list[list[str]]:
    """Group models into dependency levels (a level only reads earlier ones)."""
    depth: dict[str, int] = {}
    for n in names:   # names are in topological order
        depth[n] = 1 + max([depth[u] for u in MODELS[n].upstream if u in depth] or [0])
    return [[n for n in names if depth[n] == d] for d in sorted(set(depth.values()))]


def run_pipeline(spark: SparkSession, landing_root: str, warehouse_root: str, as_of=None,
                 selection: str | None = None, on_check_failure: str = "raise",
                 ingested_at: str | None = None, incremental: bool = False,
                 archive_dir: str | None = None, threads: int = 4,
                 csv_multiline: bool = False, on_change: str = "report") -> PipelineResult:
    """Run the whole job.

    ``selection`` picks models (``staging``, ``fact_payments+``, ``+dim_date`` …);
    ``on_check_failure`` is ``raise`` (fail closed) or ``warn`` (report only);
    ``incremental`` appends only files that the ledger does not have (re-runs
    over the same files add nothing) instead of replacing the raw tables;
    ``archive_dir`` (incremental only: a full rebuild needs the files again)
    moves the landing files that the ledger has there as the last step;
    ``threads`` independent table writes run as concurrent Spark jobs (models of
    ``ONE_BY_ONE`` loaded rows or more one after another);
    ``csv_multiline`` reads CSV fields with line breaks, files being split all the same;
    ``on_change``: a loaded file that has other content now is reported in
    ``changed`` (``report``) or stops the load (``raise``); it is not loaded again.
    """
    if on_check_failure not in ("raise", "warn"):
        raise ValueError(on_check_failure)
    if archive_dir and not incremental:
        raise ValueError("archive_dir needs incremental=True")
    if on_change not in ("report", "raise"):
        raise ValueError(on_change)
    cat, snapshots = Catalog(spark, warehouse_root), Snapshots(spark, warehouse_root)
    cat.ensure_namespaces()
    result = PipelineResult()
    loader = Loader(spark, snapshots)

    # 1. gate: every source prefix must hold files
    _stage("gate", L.require_sources, spark, landing_root, timings=result.stage_seconds)

    # 2. load: raw tables from the landing prefixes (replace, or append new files)
    manifest = _stage("load", _load, loader, landing_root, incremental, ingested_at, csv_multiline, on_change, result, threads,
                      timings=result.stage_seconds)
    loaded, raw = manifest["loaded"], {name: loader.rows(name, manifest) for name in RAW}
    candidates: dict[str, tuple[str, DataFrame, list[str]]] = {}        # name → (layer, rows, folders)
    for name in RAW:
        result.built[name] = ("raw", raw[name])
        candidates[name] = ("raw", raw[name], loaded[name]["rows"])

    # 3. transform: models in dependency order, as candidates
    models = ModelSet(raw, as_of=as_of)
    chosen = select(selection)
    written: list[str] = []
    rows = loader.ledger(manifest=manifest).agg(F.sum("rows")).first()[0] or 0
    writers = 1 if rows >= ONE_BY_ONE else threads

    def write(name: str, df: DataFrame) -> tuple[str, DataFrame]:
        path, stored = cat.write_candidate(MODELS[name].layer, name, df)
        written.append(path)
        return path, stored

    @shuffles_dropped(spark)
    def transform():
        for level in _levels(chosen):
            frames = {name: models[name] for name in level}      # plans built on this thread
            for name in CLUSTERED.keys() & frames.keys():
                frames[name] = MODELS[name].build(clustered(models[MODELS[name].upstream[0]], *CLUSTERED[name]))
            first = sorted(frames, key=lambda n: n not in CLUSTERED)        # facts are shuffled whole: while least is stored
            writes = {name: (lambda n=name, d=frames[name]: write(n, d)) for name in first if name not in PASSED_ON}
            stored = run_concurrently(writes, writers)
            for name in level:
                layer = MODELS[name].layer
                path, df = stored[name] if name in stored else (None, frames[name])
                models.override(name, df)
                result.built[name] = (layer, df)
                candidates[name] = (layer, df, [path] if path else loaded[PASSED_ON[name]]["rows"])

    # 4. test: every declared check whose relations were built, on the candidates
    @shuffles_dropped(spark)
    def test():
        built = set(result.built)
        checks = [c for c in Q.all_checks()
                  if c.model in built and (c.test != "relationships" or c.arg[0] in built)]
        path, report = cat.write_candidate("marts", "data_test_results", Q.run_checks(models.__getitem__, checks, _stored))
        result.check_report = report
        result.check_rows = [r.asDict() for r in report.collect()]  # one row per check
        entry = {"path": path, "failing": sum(r["failures"] > 0 for r in result.check_rows)}
        if on_check_failure == "raise" and entry["failing"]:
            snapshots.commit(snapshots.head(), report=entry)      # the published set stays
            Q.enforce(report)
        candidates["data_test_results"] = ("marts", report, [path])
        return entry

    try:
        _stage("transform", transform, timings=result.stage_seconds)
        report = _stage("test", test, timings=result.stage_seconds)
        _stage("publish", _publish, cat, snapshots, candidates, report, timings=result.stage_seconds)
    except PipelineError as e:
        if e.stage in ("transform", "test"):
            for path in written:
                drop_folder(spark, path)
        raise

    # 5. archive: landed files that the ledger has, as they were loaded
    if archive_dir:
        def archive():
            for name in RAW:
                result.archived[name] = loader.archive(name, landing_root, f"{archive_dir.rstrip('/')}/{name}")
        _stage("archive", archive, timings=result.stage_seconds)
    return result
