"""Snapshots of a warehouse: one small manifest names the data of every relation.

``<root>/_snapshots/<number>.json`` is written once and never changed. The
newest manifest says which folders hold what was loaded (rows and ledger of each
source) and which folders each published relation consists of. Creating the
next manifest is the only step that changes what readers see, so a set of
relations changes as a whole: a reader that opens a snapshot reads one version
of all of them, before or after, whatever is written meanwhile.

Writers are optimistic: a commit names the manifest it started from and fails
if another one has been committed since. A manifest that does not parse (its
writer died) is passed over.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_snapshots"
KEEP = 2            # manifests whose data stays, so that open readers can finish


class SnapshotConflict(RuntimeError):
    """Another run committed first; nothing of this commit is visible."""


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


@dataclass(frozen=True)
class Snapshot:
    """One version of all published relations."""
    spark: SparkSession
    number: int
    relations: dict

    def names(self) -> list[str]:
        return sorted(self.relations)

    def table(self, name: str) -> DataFrame:
        """``<namespace>.<relation>`` as of this snapshot."""
        entry = self.relations[name]
        schema = T.StructType.fromJson(entry["schema"])
        if not entry["paths"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*entry["paths"])


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.home = os.path.join(self.root, FOLDER)

    def _numbers(self) -> list[int]:
        fs, home = file_system(self.spark, self.home)
        if not fs.exists(home):
            return []
        found = (re.fullmatch(r"(\d+)\.json", f.getPath().getName()) for f in fs.listStatus(home))
        return sorted(int(m[1]) for m in found if m)

    def _path(self, number: int) -> str:
        return os.path.join(self.home, f"{number:010d}.json")

    def read(self, number: int) -> dict | None:
        """A manifest, or None if it is not whole."""
        fs, p = file_system(self.spark, self._path(number))
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:
            return None
        finally:
            stream.close()

    def head(self) -> dict:
        """The newest whole manifest; number 0 with nothing in it before the first."""
        for number in reversed(self._numbers()):
            manifest = self.read(number)
            if manifest is not None:
                return manifest
        return {"number": 0, "loaded": {}, "published": {}, "report": None}

    def open(self) -> Snapshot:
        head = self.head()
        return Snapshot(self.spark, head["number"], head["published"])

    def commit(self, base: dict, **changed) -> dict:
        """Write the manifest after ``base`` with the parts ``changed``."""
        numbers = self._numbers()
        if self.head()["number"] != base["number"]:
            raise SnapshotConflict(f"snapshot {base['number']} is not the newest any more")
        manifest = {**base, **changed, "number": max(numbers, default=0) + 1}
        if "published" in changed:
            manifest["published_in"] = manifest["number"]
        fs, p = file_system(self.spark, self._path(manifest["number"]))
        try:
            out = fs.create(p, False)           # fails if another writer took the number
        except Exception as e:
            raise SnapshotConflict(f"snapshot {manifest['number']} exists") from e
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        return manifest

    @staticmethod
    def paths(manifest: dict) -> set[str]:
        """Every folder that a manifest names."""
        loaded = {p for entry in manifest["loaded"].values() for part in entry.values() for p in part}
        published = {p for entry in manifest["published"].values() for p in entry["paths"]}
        report = {manifest["report"]["path"]} if manifest["report"] else set()
        return loaded | published | report

    def ever(self) -> set[str]:
        """Every folder that a manifest still there names."""
        return set().union(set(), *(self.paths(m) for m in map(self.read, self._numbers()) if m is not None))

    def forget(self, keep: int = KEEP) -> int:
        """Keep the newest manifest and the last one of each of the ``keep``
        newest published sets; remove the others, and first the folders that
        only they name. Folders of a run that is under way are in no manifest,
        so they are not touched."""
        whole = [m for m in map(self.read, self._numbers()) if m is not None]
        last = {m.get("published_in", 0): m for m in whole}             # the last manifest of each published set
        kept = [last[v] for v in sorted(last)[-keep:]]
        old = [m for m in whole if m not in kept]
        gone = set().union(set(), *map(self.paths, old)) - set().union(set(), *map(self.paths, kept))
        for path in sorted(gone):
            drop_folder(self.spark, path)
        for m in old:
            drop_folder(self.spark, self._path(m["number"]))
        return len(gone)
