"""Token files: one wavelet matrix per shard (see ``wavelet``).

Documents are range-partitioned by doc_id, so shards follow each other in
ascending doc_id order. A task encodes its documents and writes one file for
every ``SHARD_TOKENS`` ids to the shared folder, under a name made of its
range and a running number: written under a temporary name and then renamed,
so a repeated task leaves the same file. Reading takes the manifest (a row a
shard), opens each file in a task, and adds the ids of the shards before.

The shared folder must be on a file system that pyarrow opens (local or
mounted path, hdfs, s3, gs).

Defined results
  null or empty text    only the end id
  very long text        encoded whole; a shard holds at least one document
  special-token strings in a text    the ids the library gives by default
  null doc_id           first, before all numbers
  repeated doc_id       equal ids are neighbours, ordered by a hash of their text
  empty table           no files, no rows
  extra columns         ignored
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks_for, new_dir, small_batches, stored, table
from ledgerloom.llm.tokens import ByteLevelEncoder
from ledgerloom.llm.wavelet import WaveletMatrix, from_bytes, to_bytes

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
RANGE_BYTES = 12 << 20          # text of a range
SHARD_TOKENS = 8 << 20          # a shard is closed when it has so many ids


def _open(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def write_file(uri: str, data: bytes, attempt: int) -> None:
    files, path = _open(uri)
    if files.type_name in ("local", "hdfs"):
        files.create_dir(os.path.dirname(path), recursive=True)
    with files.open_output_stream(f"{path}.{attempt}.tmp") as out:
        out.write(data)
    files.move(f"{path}.{attempt}.tmp", path)


def read_file(uri: str) -> bytes:
    files, path = _open(uri)
    with files.open_input_file(path) as f:
        return f.read()


def write_shards(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the files; the stored manifest: range, part, uri, tokens, start."""
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = docs.select(F.col("doc_id").cast("long"), "text") \
        .repartitionByRange(blocks_for(size, RANGE_BYTES), "doc_id") \
        .sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encoder = TaskContext.get(), ByteLevelEncoder.get(vocabulary)
        doc_ids, texts, n, part = [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, texts, n, part
            ids = np.frombuffer(b"".join(texts), "<u4")
            uri = f"{folder}/shard-{task.partitionId():06d}-{part:04d}.wmx"
            lengths = [len(x) // 4 for x in texts]
            texts = []
            write_file(uri, to_bytes(WaveletMatrix.build(ids), doc_ids, lengths), task.taskAttemptId())
            row = pa.RecordBatch.from_pydict({"range": [task.partitionId()], "part": [part], "uri": [uri],
                                              "tokens": [len(ids)]}, schema=manifest)
            doc_ids, n, part = [], 0, part + 1
            return row

        for b in batches:
            doc_ids += b.column("doc_id").to_pylist()
            new = encoder.encode(b.column("text").to_pylist(), end_id)
            texts += new
            n += sum(map(len, new)) // 4
            if n >= shard_tokens:
                yield close()
        if doc_ids:
            yield close()

    manifest = pa.schema([("range", pa.int32()), ("part", pa.int32()), ("uri", pa.string()), ("tokens", pa.int64())])
    shards = stored(ordered.mapInArrow(run, "range int, part int, uri string, tokens long"), "manifest")
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)     # a row a shard
    return shards.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_shards(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    spark = manifest.sparkSession
    files = manifest.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, start in zip(b.column("uri").to_pylist(), b.column("start").to_pylist()):
                matrix, doc_ids, lengths = from_bytes(read_file(uri))
                ids = matrix.all_ids()
                ends = np.cumsum(lengths, dtype=np.int64)
                crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.select("uri", "start").repartition(max(1, files), "uri")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_shards(table(spark, sf_dir, "documents"), new_dir(spark, "tokens"))
    return read_shards(manifest)
