"""Loads with a ledger: which landed files were loaded, with what content.

The ledger has a row for each loaded file (path in the stage, size, modification
time, digest of its records, rows, load time, run). It is committed in the
same manifest as the rows, so the two never differ.

A load compares the listing with the ledger. New files are read in batches; a
batch's rows and ledger rows go to a folder of its own that no reader knows. When
all batches of all sources are written, one commit adds them; a bad file stops
the load before that, so its target stays as it was. Batches that were finished
stay pending, and the next load takes them over without reading their files again,
unless a file of theirs has changed or gone.

A known file whose size or time differs is read again and compared by digest:
equal records are nothing new; others are reported and not loaded. The digest
does not depend on the order of a file's records.
"""

from __future__ import annotations

import os
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.variant import utc_now
from ledgerloom.plans.snapshots import Snapshots, drop_folder, file_system
from ledgerloom.schemas import AI_USAGE_EVENTS, CSV_TABLES
from ledgerloom.session import run_dir
from ledgerloom.sources import landing as L
from ledgerloom.sources.csv_records import parse_records, split_records

FILES_PER_BATCH = 1000
COMPACT_AT = 64             # folders of a source, beyond which a load rewrites them as one
LEDGER = ("source string, stage_path string, length long, modified timestamp, digest string, rows long, "
          "loaded_at timestamp_ntz, run string")
BATCH = "b-"


class ChangedFiles(RuntimeError):
    pass


@dataclass
class Staged:
    """What a load found for one source and where its batches are."""
    source: str
    batches: list[str]
    rows: int
    changed: list[str] = field(default_factory=list)     # known names with other content


def raw_schema(source: str):
    return AI_USAGE_EVENTS if source == "ai_usage_events" else CSV_TABLES[source]


def _stage_name(path: Column) -> Column:
    # the metadata column encodes a name as in a URL, where a plus sign stands for itself
    return L.stage_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def _seen(records: DataFrame) -> DataFrame:
    """``_file`` (its path in the stage), rows and digest of each file's records,
    in any order. The sum of the hashes is kept in two halves, and a path is
    worked out once a file, not once a record."""
    r = F.col("_record")
    parts = records.groupBy("_file").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(r).alias("xor"), F.sum(F.shiftright(r, 32)).alias("high"),
        F.sum(r.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"))
    files = parts.groupBy(_stage_name(F.col("_file")).alias("_file")).agg(
        F.sum("rows").alias("rows"), F.bit_xor("xor").alias("xor"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    total = F.col("high").cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(11,0)") + F.col("low")
    return files.select("_file", "rows", F.concat_ws("-", F.hex("xor"), total.cast("decimal(38,0)").cast("string")).alias("digest"))


class Loader:
    def __init__(self, spark: SparkSession, snapshots: Snapshots):
        self.spark = spark
        self.snapshots = snapshots
        self.run = uuid.uuid4().hex[:12]

    # ------------------------------------------------------------ what is there

    def ledger(self, source: str | None = None, manifest: dict | None = None) -> DataFrame:
        """The committed ledger."""
        loaded = (manifest or self.snapshots.head())["loaded"]
        paths = [p for name, entry in loaded.items() if source in (None, name) for p in entry["files"]]
        return self._files(paths)

    def _files(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(*paths) if paths else self.spark.createDataFrame([], LEDGER)

    def rows(self, source: str, manifest: dict | None = None) -> DataFrame:
        """The committed raw table."""
        paths = (manifest or self.snapshots.head())["loaded"].get(source, {}).get("rows", [])
        schema = raw_schema(source)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def home(self, source: str) -> str:
        return os.path.join(self.snapshots.root, "raw", source)

    def pending(self, source: str) -> list[str]:
        """Finished batches that no commit had."""
        fs, home = file_system(self.spark, self.home(source))
        if not fs.exists(home):
            return []
        known = self.snapshots.ever()
        found = [os.path.join(self.home(source), f.getPath().getName()) for f in fs.listStatus(home)
                 if f.getPath().getName().startswith(BATCH)]
        done = lambda b: fs.exists(file_system(self.spark, f"{b}/files/_SUCCESS")[1])     # noqa: E731
        return sorted(b for b in found if f"{b}/files" not in known and done(b))

    # ------------------------------------------------------------ reading files

    def _records(self, source: str, paths: list[str], multiline: bool, strict: bool = True) -> DataFrame:
        """Records of landed files as they are, with ``_file`` (its path as Spark
        writes it) and ``_record`` (a hash)."""
        split = multiline and source != "ai_usage_events"
        file = F.col("_path" if split else "_metadata.file_path").alias("_file")
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in paths]      # names, not patterns
        mode = "FAILFAST" if strict else "PERMISSIVE"
        if source == "ai_usage_events":
            raw = self.spark.read.option("singleVariantColumn", "raw_event").option("mode", mode).json(paths)
            return raw.select("raw_event", file, F.xxhash64(F.to_json("raw_event")).alias("_record"))
        schema = L.string_schema(CSV_TABLES[source])
        if split:
            raw = parse_records(split_records(self.spark, paths, run_dir(self.spark, "csv"), strict), schema, mode)
        else:
            raw = self.spark.read.schema(schema).options(**{**L.csv_options(False), "mode": mode}).csv(paths)
        each = [F.coalesce(F.col(c), F.lit("\0")) for c in schema.fieldNames()]
        return raw.select(*schema.fieldNames(), file, F.xxhash64(*each).alias("_record"))

    def _typed(self, source: str, records: DataFrame, ingested_at: str | None) -> DataFrame:
        if source != "ai_usage_events":
            return records.select(*L.typed_csv_columns(source), "_file", "_record")
        at = utc_now() if ingested_at is None else F.lit(ingested_at).cast("timestamp_ntz")
        return records.select("raw_event", _stage_name(F.col("_file")).alias("source_file"), at.alias("ingested_at"), "_file", "_record")

    def _write_batch(self, source: str, files: DataFrame, paths: list[str], ingested_at, multiline: bool) -> str:
        """Rows first, then the ledger rows, whose _SUCCESS marks the batch as done."""
        folder = os.path.join(self.home(source), f"{BATCH}{uuid.uuid4().hex[:12]}")
        self._typed(source, self._records(source, paths, multiline), ingested_at).write.option("compression", "zstd").parquet(f"{folder}/rows")
        seen = _seen(self.spark.read.parquet(f"{folder}/rows"))
        (files.join(seen, files["stage_path"] == seen["_file"], "left")
              .select(F.lit(source).alias("source"), "stage_path", "length", "modified", F.coalesce("digest", F.lit("0-0")).alias("digest"),
                      F.coalesce("rows", F.lit(0)).alias("rows"), utc_now().alias("loaded_at"), F.lit(self.run).alias("run"))
              .write.parquet(f"{folder}/files"))
        return folder

    # ------------------------------------------------------------ a load

    def _listing(self, source: str, landing_root: str) -> DataFrame:
        prefix = L.prefix_path(landing_root, source)
        if not L.has_files(self.spark, prefix):
            return self.spark.createDataFrame([], "path string, stage_path string, length long, modified timestamp")
        return L.list_stage(self.spark, prefix).withColumnRenamed("modificationTime", "modified")

    def _usable(self, source: str, listing: DataFrame) -> list[str]:
        """Pending batches whose files are all still there as they were read;
        the others are removed."""
        kept = []
        for batch in self.pending(source):
            if self._files([f"{batch}/files"]).join(listing, ["stage_path", "length", "modified"], "left_anti").limit(1).count():
                drop_folder(self.spark, batch)
            else:
                kept.append(batch)
        return kept

    def stage(self, source: str, landing_root: str, append: bool = True, ingested_at: str | None = None,
              multiline: bool = False, on_change: str = "report", files_per_batch: int = FILES_PER_BATCH) -> Staged:
        """Read the files of ``source`` that the ledger does not have (all of
        them unless ``append``) into batches. Nothing is visible before ``commit``."""
        listing = self._listing(source, landing_root).cache()
        try:
            batches = self._usable(source, listing)
            known = self.ledger(source) if append else self._files([])
            known = known.unionByName(self._files([f"{b}/files" for b in batches])).select(
                "stage_path", F.col("length").alias("was_length"), F.col("modified").alias("was_modified"), F.col("digest").alias("was_digest"))
            found = listing.join(known, "stage_path", "left")
            new = found.where(F.col("was_length").isNull()).select("path", "stage_path", "length", "modified")
            changed = self._changed(source, found.where(
                F.col("was_length").isNotNull() & ((F.col("length") != F.col("was_length")) | (F.col("modified") != F.col("was_modified")))), multiline)
            if changed and on_change == "raise":
                raise ChangedFiles(f"{source}: loaded files with other content: {', '.join(changed[:5])}")
            names = [r.path for r in new.select("path").orderBy("path").toLocalIterator()]      # Spark's reader takes names
            for at in range(0, len(names), files_per_batch):
                part = names[at:at + files_per_batch]
                files = new.where(F.col("path").between(part[0], part[-1])).select("stage_path", "length", "modified")
                batches.append(self._write_batch(source, files, part, ingested_at, multiline))
        finally:
            listing.unpersist()
        rows = self._files([f"{b}/files" for b in batches]).agg(F.sum("rows")).first()[0] or 0
        return Staged(source, batches, rows, changed)

    def _changed(self, source: str, suspects: DataFrame, multiline: bool) -> list[str]:
        """Of known files with another size or time, those with other records."""
        paths = [r.path for r in suspects.select("path").toLocalIterator()]
        if not paths:
            return []
        now = _seen(self._records(source, paths, multiline, strict=False)).drop("rows")
        differs = F.coalesce("digest", F.lit("0-0")) != F.col("was_digest")
        return [r.stage_path for r in suspects.join(now, F.col("stage_path") == F.col("_file"), "left").where(differs)
                .select("stage_path").orderBy("stage_path").toLocalIterator()]

    def commit(self, staged: list[Staged], append: bool = True) -> dict:
        """One manifest adds all batches (or replaces what was loaded)."""
        base = self.snapshots.head()
        loaded = dict(base["loaded"])
        for s in staged:
            entry = loaded.get(s.source) if append else None
            rows, files = (entry["rows"], entry["files"]) if entry else ([], [])
            if len(rows) >= COMPACT_AT and s.batches:
                rows, files = self._compacted(s.source, rows, files)        # committed ones only: a batch is in a manifest first
            loaded[s.source] = {"rows": rows + [f"{b}/rows" for b in s.batches], "files": files + [f"{b}/files" for b in s.batches]}
        if loaded == base["loaded"]:
            return base
        return self.snapshots.commit(base, loaded=loaded)

    def _compacted(self, source: str, rows: list[str], files: list[str]) -> tuple[list[str], list[str]]:
        folder = os.path.join(self.home(source), f"{BATCH}{uuid.uuid4().hex[:12]}")
        self.spark.read.parquet(*rows).write.option("compression", "zstd").parquet(f"{folder}/rows")
        self._files(files).coalesce(8).write.parquet(f"{folder}/files")
        return [f"{folder}/rows"], [f"{folder}/files"]

    # ------------------------------------------------------------ archive

    def archive(self, source: str, landing_root: str, archive_path: str) -> int:
        """Move the landed files that the committed ledger has, as they were
        loaded, to the same place under ``archive_path``. A file that came or
        changed since is not in the ledger and stays. One at a time from an
        iterator: nothing is held."""
        listing = self._listing(source, landing_root)
        loaded = listing.join(self.ledger(source), ["stage_path", "length", "modified"], "left_semi")
        fs, base = file_system(self.spark, L.prefix_path(landing_root, source))
        root, moved = fs.makeQualified(base).toUri().getPath().rstrip("/"), 0
        for r in loaded.select("path").toLocalIterator():
            at = file_system(self.spark, r.path)[1]
            to = file_system(self.spark, archive_path.rstrip("/") + at.toUri().getPath()[len(root):])[1]
            fs.mkdirs(to.getParent())
            if not fs.rename(at, to):
                raise OSError(f"could not archive {r.path}")
            moved += 1
        return moved


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Files, rows and loads of each source."""
    return ledger.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
                                        F.count_distinct("run").alias("loads"))
