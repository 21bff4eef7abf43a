"""Landing zone: partitioned writes, CSV / JSON loaders, listing, presence gate.

Layout under a landing root (one prefix per source):

    postgres/accounts/ingestion_date=YYYY-MM-DD/part-*.csv
    postgres/subscriptions/ingestion_date=…/
    external/payments/ingestion_date=…/
    external/support_tickets/ingestion_date=…/
    events/ai_usage/year=YYYY/month=MM/part-*.txt   (one JSON object per line)

Loads read a whole prefix with the file source; executors read the files in
parallel, nothing passes through the driver.
"""

from __future__ import annotations

import logging
import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.variant import utc_now
from ledgerloom.schemas import CSV_NULL_MARKERS, CSV_TABLES, LANDING_PREFIX, MAX_LENGTH
from ledgerloom.session import run_dir, shuffles_dropped
from ledgerloom.sources.csv_records import parse_records, split_records
from ledgerloom.sources.listing import list_files

logger = logging.getLogger(__name__)

# CSV dialect shared by writer and reader: '"' quotes and escapes itself,
# timestamps keep microseconds.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}

# A compressed file is read by one task, so it holds at most so many records.
COMPRESSED_RECORDS = 500_000


def prefix_path(root: str, source: str) -> str:
    return os.path.join(root, LANDING_PREFIX[source])


# ---------------------------------------------------------------- writes (SNK1)

def _capped(writer, max_records_per_file: int | None, compression: str | None = None):
    if compression:     # fastest level: a quarter larger than the default one, at half its time
        writer = writer.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
        max_records_per_file = max_records_per_file or COMPRESSED_RECORDS
    return writer.option("maxRecordsPerFile", max_records_per_file) if max_records_per_file else writer


def write_csv_landing(df: DataFrame, root: str, source: str, ingestion_date: str, mode: str = "append",
                      max_records_per_file: int | None = None, compression: str | None = None) -> str:
    """``max_records_per_file`` matters for streaming loads with
    ``multiline=True`` and for compressed files (``compression``: ``gzip`` …,
    which loads tell by the file's name), where a file is one split."""
    path = prefix_path(root, source)
    writer = df.withColumn("ingestion_date", F.lit(ingestion_date)).write.mode(mode).options(**CSV_OPTIONS)
    _capped(writer, max_records_per_file, compression).partitionBy("ingestion_date").csv(path)
    return path


def write_json_landing(json_lines: DataFrame, root: str, year: int | None = None, month: int | None = None,
                       mode: str = "append", compression: str | None = None) -> str:
    """``json_lines`` has one string column ``value`` holding a JSON object.
    Without ``year`` and ``month`` each event goes to the folder of its own
    timestamp's month."""
    path = prefix_path(root, "ai_usage_events")
    at = F.get_json_object("value", "$.event_timestamp")
    writer = json_lines.select("value", (F.substring(at, 1, 4) if year is None else F.lit(f"{year:04d}")).alias("year"),
                               (F.substring(at, 6, 2) if month is None else F.lit(f"{month:02d}")).alias("month")).write.mode(mode)
    _capped(writer, None, compression).partitionBy("year", "month").text(path)
    return path


def write_landing(spark: SparkSession, sf_dir: str, root: str, ingestion_date: str, year: int | None = None,
                  month: int | None = None, threads: int = 4, compression: str | None = None) -> dict[str, str | None]:
    """Land all five sources derived from the driver tables (concurrent jobs).
    A source whose input is not there is reported (logged, and None in the
    result) and skipped; the others are landed."""
    from ledgerloom.plans.parallel import run_concurrently
    from ledgerloom.sources import driver_tables as DT
    builders = {name: getattr(DT, name) for name in CSV_TABLES} | {"ai_usage_events": DT.event_json_lines}
    frames: dict[str, DataFrame] = {}
    for name, build in builders.items():
        try:
            frames[name] = build(spark, sf_dir)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            logger.warning("source %s skipped: %s", name, str(e).splitlines()[0])
    tasks = {name: (lambda n=name, d=df: write_csv_landing(d, root, n, ingestion_date, compression=compression) if n in CSV_TABLES
                    else write_json_landing(d, root, year, month, compression=compression)) for name, df in frames.items()}
    with shuffles_dropped(spark):
        landed = run_concurrently(tasks, threads)
    return {name: landed.get(name) for name in builders}


# ---------------------------------------------------------------- loads (SRC1/2, LD1-6, LD8)

def string_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def null_markers(c: Column) -> Column:
    """NULL_IF = ('NULL', 'null', '') — one ``nullValue`` option cannot hold three."""
    return F.when(~c.isin(*CSV_NULL_MARKERS), c)


def _within(c: Column, name: str, most: int | None) -> Column:
    """The value, null for a marker, or an error that aborts the load if it is
    longer than declared. Each test is made once a value."""
    if most is not None:
        kept = F.when(F.length(c) > most, F.raise_error(F.concat(F.lit(f"{name} longer than {most}: "), c))).otherwise(c)
        return F.when(~c.isin(*CSV_NULL_MARKERS), kept)
    return null_markers(c)


def typed_csv_columns(source: str) -> list[Column]:
    """String columns → typed columns. A bad value (ANSI cast) or one that is
    too long raises, which aborts the load (ON_ERROR = ABORT_STATEMENT)."""
    lengths = MAX_LENGTH[source]
    return [_within(F.col(f.name), f.name, lengths.get(f.name)).cast(f.dataType).alias(f.name)
            for f in CSV_TABLES[source].fields]


def type_csv_columns(df: DataFrame, source: str) -> DataFrame:
    return df.select(*typed_csv_columns(source))


def csv_options(multiline: bool) -> dict[str, str]:
    # columns bind by position (the header line is skipped, not matched);
    # FAILFAST aborts on a malformed line
    return {**CSV_OPTIONS, "enforceSchema": "true", "mode": "FAILFAST", "multiLine": "true" if multiline else "false"}


def load_csv(spark: SparkSession, path: str, source: str, multiline: bool = False) -> DataFrame:
    """COPY INTO <source> from a landing prefix: typed, partition columns dropped.

    Files are split among tasks. ``multiline=True`` allows line breaks inside
    quoted fields (``sources.csv_records``: lines are stored once in the shared
    folder when the load is planned, so that files are still split).
    """
    if multiline:
        records = split_records(spark, path, run_dir(spark, "csv"))
        return type_csv_columns(parse_records(records, string_schema(CSV_TABLES[source])), source)
    reader = spark.read.schema(string_schema(CSV_TABLES[source])).options(**csv_options(multiline))
    return type_csv_columns(reader.csv(path), source)


def stage_path(file_path: Column) -> Column:
    """A landed file's path inside the stage: from the last source prefix on
    (file and partition names hold none), so moving the lake changes nothing."""
    return F.regexp_extract(file_path, rf"^.*/((?:{'|'.join(LANDING_PREFIX.values())})/.*)$", 1)


def load_json_variant(spark: SparkSession, path: str, ingested_at: str | None = None) -> DataFrame:
    """COPY INTO AI_USAGE_EVENTS: each JSON line → VARIANT, plus lineage.

    ``source_file`` is the file's path inside the stage (METADATA$FILENAME);
    ``ingested_at`` is the load time in UTC, or ``ingested_at`` when given.
    """
    raw = spark.read.option("singleVariantColumn", "raw_event").option("mode", "FAILFAST") \
        .option("recursiveFileLookup", "true").json(path)       # no partition columns beside the variant
    at = utc_now() if ingested_at is None else F.lit(ingested_at).cast("timestamp_ntz")
    return raw.select(
        F.col("raw_event"),
        stage_path(F.col("_metadata.file_path")).alias("source_file"),
        at.alias("ingested_at"),
    )


def load_all(spark: SparkSession, root: str, ingested_at: str | None = None,
             csv_multiline: bool = False) -> dict[str, DataFrame]:
    out = {name: load_csv(spark, prefix_path(root, name), name, csv_multiline) for name in CSV_TABLES}
    out["ai_usage_events"] = load_json_variant(spark, prefix_path(root, "ai_usage_events"), ingested_at)
    return out


def relative_source_dir(source_file: Column) -> Column:
    """``events/ai_usage/year=2026/month=09/part-….txt`` → ``events/ai_usage/year=2026/month=09``."""
    return F.regexp_extract(source_file, "^(.*)/[^/]+$", 1)


# ---------------------------------------------------------------- listing and gate (SRC4/5)

def list_stage(spark: SparkSession, root: str) -> DataFrame:
    """LIST @stage: every landed file with its path inside the stage, size and
    modification time.

    ``binaryFile`` reads no contents unless ``content`` is selected; Spark lists
    the folders (in parallel where there are many) and the driver holds the list.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
                 .select("path", stage_path(F.col("path")).alias("stage_path"), "length", "modificationTime"))


def stage_folders(spark: SparkSession, root: str) -> DataFrame:
    """The listing by source and partition folder: whether it has files and bytes.
    Each folder is listed by a task."""
    source = F.lit(None).cast("string")
    for name, prefix in LANDING_PREFIX.items():
        source = F.when(F.col("folder").startswith(prefix + "/"), F.lit(name)).otherwise(source)
    return (list_files(spark, root).withColumn("folder", relative_source_dir(F.col("stage_path")))
            .withColumn("source", source).where(F.col("source").isNotNull())
            .groupBy("source", "folder")
            .agg((F.count(F.lit(1)) > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes")))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a visible file lies under ``path``; stops at the first."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    found, top = fs.listFiles(p, True), len(fs.makeQualified(p).toString().rstrip("/")) + 1
    while found.hasNext():
        below = found.next().getPath().toString()[top:]
        if not any(part[:1] in (".", "_") for part in below.split("/")):      # no hidden file, none of an unfinished write
            return True
    return False


def source_presence(spark: SparkSession, root: str, prefixes: list[tuple[str, str]] | None = None) -> DataFrame:
    """source, prefix, present: one probe a prefix (the five sources' by
    default), no listing of the lake."""
    rows = [(name, prefix, has_files(spark, os.path.join(root, prefix)))
            for name, prefix in (prefixes or LANDING_PREFIX.items())]
    return spark.createDataFrame(rows, "source string, prefix string, present boolean")


class MissingSourceError(RuntimeError):
    pass


def require_sources(spark: SparkSession, root: str) -> list[dict]:
    """Gate: raise unless every source prefix holds at least one file."""
    rows = [r.asDict() for r in source_presence(spark, root).collect()]  # five rows
    missing = [r["source"] for r in rows if not r["present"]]
    if missing:
        raise MissingSourceError(f"no landed files for: {', '.join(sorted(missing))}")
    return rows
