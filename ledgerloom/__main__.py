"""Command line: ``python -m ledgerloom {land,run,clean} …`` (or via spark-submit).

    land  write the five sources derived from driver tables to a landing root
    run   gate → load → transform → test on a landing root; exit 1 on failure
    clean remove run folders that have not been touched for some hours
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ledgerloom.session import apply_core_conf


def _session(master: str | None, ui: bool) -> SparkSession:
    b = (SparkSession.builder.appName("ledgerloom")
         .config("spark.ui.enabled", "true" if ui else "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    apply_core_conf(spark)
    return spark


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerloom")
    ap.add_argument("--master", default=None, help="only when not launched by spark-submit")
    ap.add_argument("--ui", action="store_true", help="start Spark's web UI (off by default)")
    sub = ap.add_subparsers(dest="cmd", required=True)

    land = sub.add_parser("land", help="land driver-derived sources")
    land.add_argument("--sf-dir", required=True)
    land.add_argument("--landing", required=True)
    land.add_argument("--ingestion-date", required=True)
    land.add_argument("--year", type=int, required=True)
    land.add_argument("--month", type=int, required=True)

    run = sub.add_parser("run", help="run the pipeline")
    run.add_argument("--landing", required=True)
    run.add_argument("--warehouse", required=True)
    run.add_argument("--as-of", default=None)
    run.add_argument("--select", default=None, help="e.g. 'staging', 'fact_payments+', '+dim_date'")
    run.add_argument("--warn", action="store_true", help="report failing checks instead of failing")
    run.add_argument("--incremental", action="store_true")
    run.add_argument("--archive-dir", default=None)
    run.add_argument("--threads", type=int, default=4, help="concurrent table writes")
    run.add_argument("--multiline-csv", action="store_true",
                     help="CSV fields may hold line breaks")

    clean = sub.add_parser("clean", help="remove old run folders from the shared folder")
    clean.add_argument("--older-than-hours", type=float, default=24.0)

    args = ap.parse_args(argv)
    spark = _session(args.master, args.ui)
    if args.cmd == "clean":
        from ledgerloom.session import clean_runs
        print(clean_runs(spark, args.older_than_hours))
        return 0
    if args.cmd == "land":
        from ledgerloom.sources.landing import write_landing
        for name, path in write_landing(spark, args.sf_dir, args.landing, args.ingestion_date,
                                        args.year, args.month).items():
            print(f"{name}\t{path or 'missing, skipped'}")
        return 0

    from ledgerloom.plans.pipeline import PipelineError, run_pipeline
    try:
        res = run_pipeline(spark, args.landing, args.warehouse, as_of=args.as_of,
                           selection=args.select, on_check_failure="warn" if args.warn else "raise",
                           incremental=args.incremental, archive_dir=args.archive_dir,
                           threads=args.threads, csv_multiline=args.multiline_csv)
    except PipelineError as e:
        print(f"FAILED at {e.stage}: {e.cause}", file=sys.stderr)
        return 1
    for r in res.summary().collect():        # a row a relation
        print(f"{r.layer}\t{r.table_name}\t{r.rows}")
    failing = [r for r in res.check_rows if r["failures"]]
    print(f"{len(res.check_rows)} checks, {len(failing)} failing")
    return 0


if __name__ == "__main__":
    sys.exit(main())
