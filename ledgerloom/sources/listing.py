"""LIST as a data source: the files of a stage, each folder listed by a task.

``spark.read.format("stage_files").option("depth", "3").load(root)`` gives path,
stage_path, length and modificationTime of every visible file under ``root``. The
driver walks the folders of the first levels only (a level for the systems, one
for their tables, one for days or years); what lies below each of them is listed
by a task, so neither a file index nor the list of files is held by the driver.

Filters on ``stage_path`` (equal, starts with) keep folders that cannot hold a
match from being listed, and filters on ``modificationTime`` drop files where they
are listed; Spark applies both again. Names with a leading dot or underscore, at
any level below the root, are hidden, as for Spark's own readers. A root that is
missing is an error; an empty one has no rows.

Files are listed with ``pyarrow.fs``: a path, or a URI that it opens (``s3a://`` is
read as ``s3://``). Tasks need the package on their Python path.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    InputPartition, LessThan, LessThanOrEqual, StringStartsWith)

from ledgerloom.schemas import LANDING_PREFIX

SCHEMA = "path string, stage_path string, length long, modificationTime timestamp"
ARROW = pa.schema([("path", pa.string()), ("stage_path", pa.string()), ("length", pa.int64()),
                   ("modificationTime", pa.timestamp("us", "UTC"))])
DEPTH = 3                   # folder levels that the driver walks
BATCH_ROWS = 10_000
STAGE = re.compile(rf"^.*/((?:{'|'.join(LANDING_PREFIX.values())})/.*)$", re.S)
AFTER, BEFORE = (GreaterThan, GreaterThanOrEqual), (LessThan, LessThanOrEqual)


def _open(root: str) -> tuple[pafs.FileSystem, str, str]:
    """The file system, the root's path in it, and what makes a path there a URI."""
    at = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "/", root))
    if at.startswith("/"):
        return pafs.LocalFileSystem(), at.rstrip("/") or "/", "file:"
    system, path = pafs.FileSystem.from_uri(at)
    uri = re.match(r"^[a-z0-9]+://", root).group()
    if not uri.startswith("s3"):        # the host is no part of the path
        uri = re.match(r"^[a-z0-9]+://[^/]*", root).group()
    return system, path.rstrip("/"), uri


def _visible(path: str) -> bool:
    return path.rsplit("/", 1)[-1][:1] not in (".", "_")


def stage_path(path: str) -> str:
    found = STAGE.match(path)
    return found.group(1) if found else ""


@dataclass
class Folder(InputPartition):
    path: str
    recursive: bool


class StageFilesReader(DataSourceReader):
    def __init__(self, root: str, depth: int):
        self.root, self.depth = root, depth
        self.starts: list[str] = []             # of stage paths; all must fit
        self.after = self.before = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if name == ("stage_path",) and isinstance(f, (EqualTo, StringStartsWith)) and value:
                self.starts.append(value)
            elif name == ("modificationTime",) and isinstance(value, dt.datetime) and value.tzinfo:
                if isinstance(f, AFTER):
                    self.after = max(self.after or value, value)
                elif isinstance(f, BEFORE):
                    self.before = min(self.before or value, value)
            yield f                             # applied by Spark as well

    def _may_hold(self, folder: str) -> bool:
        """Whether a file below the folder can have such a stage path."""
        at = stage_path(folder + "/")
        return not at or all(s.startswith(at) or at.startswith(s) for s in self.starts)

    def partitions(self) -> list[Folder]:
        system, root, _ = _open(self.root)
        level, out = [root], []
        for _ in range(self.depth):
            below = []
            for folder in level:
                found = system.get_file_info(pafs.FileSelector(folder))
                if any(i.type == pafs.FileType.File for i in found):
                    out.append(Folder(folder, False))
                below += sorted(i.path for i in found if i.type == pafs.FileType.Directory and _visible(i.path))
            level = [b for b in below if self._may_hold(b)]
        return out + [Folder(b, True) for b in level]

    def _files(self, system: pafs.FileSystem, folder: Folder) -> Iterator[pafs.FileInfo]:
        todo = [folder.path]
        while todo:                             # a folder at a time, hidden ones not at all
            for i in system.get_file_info(pafs.FileSelector(todo.pop(), allow_not_found=True)):
                if not _visible(i.path):
                    continue
                if i.type == pafs.FileType.Directory and folder.recursive:
                    todo.append(i.path)
                elif i.type == pafs.FileType.File and (not self.after or i.mtime >= self.after) \
                        and (not self.before or i.mtime <= self.before):
                    yield i

    def read(self, partition: Folder | None) -> Iterator[pa.RecordBatch]:
        if partition is None:                   # nothing to list
            return
        system, _, uri = _open(self.root)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)

        for i in self._files(system, partition):
            rows.append((uri + i.path, stage_path(i.path), i.size, i.mtime))
            if len(rows) == BATCH_ROWS:
                yield batch()
                rows = []
        if rows:
            yield batch()


class StageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "stage_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> StageFilesReader:
        return StageFilesReader(self.options["path"], int(self.options.get("depth", DEPTH)))


def list_files(spark: SparkSession, root: str, depth: int = DEPTH) -> DataFrame:
    spark.dataSource.register(StageFiles)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("stage_files").option("depth", str(depth)).load(root)
