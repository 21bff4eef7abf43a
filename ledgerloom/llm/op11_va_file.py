"""Exact top-k search by a vector-approximation file.

Every row's components are quantised: each component has up to ``CELLS`` cells,
cut where the cube root of a bounded sample's density has equal shares (narrow
cells where values are dense; values outside the sample's range have the two
outermost cells for themselves), and a row keeps the number of its cell for
each component (half a byte each). A cell is a range of whole numbers, its
outermost edges the least and the largest value of the whole table, so the
cells of a row bound its inner product with a query from both sides.

The file is stored in shards. A search scans a shard's cells for bounds, drops
every row whose upper bound is under a score that ``k`` rows are known to reach
(the k-th best of the sample, computed exactly, or the k-th largest lower
bound), and reads the exact vectors of the others in the order of their upper
bounds until the k-th best score exceeds the next bound. Shards' results merge
by one window over (query, score). Results are exact: sample and cells only
decide how much is read.

Defined results
  null vector, null or non-finite component, null vec_id, or a number of
  components other than the table's most frequent one
                       takes no part, as query or candidate
  zero vector          takes part
  tied scores          the smaller vec_id first, also at the k-th place
  repeated vec_id      rows of the query's own vec_id are no candidates; equal
                       rows are returned once for each row; of a query id with
                       several vectors the one of smallest bytes asks
  fewer candidates     all of them
  empty table          no rows
  extra columns        ignored
  components over 2 ** 53 after scaling are held to it, scores to a long
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import vectors as V
from ledgerloom.llm.common import blocks_for, share_of, stored, table

SCALE = 64
K = 20
CELLS = 16
SAMPLE_ROWS = 4096          # cell edges and first thresholds are learned from about so many rows
SHARD_ROWS = 1 << 16
LEAST_SHARDS = 12           # of a small table, for parallel work
QUERY_BLOCK = 64
READ = 64                   # exact vectors read at a time

SCHEMA = "query_id long, vec_id long, copies long, score long"


class Cells:
    """Quantiser: for each component the last value of each cell."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, most: np.ndarray, cells: int = CELLS):
        self.marks = []
        for j in range(sample.shape[1]):
            at = (sample[:, j].min(), sample[:, j].max() + 1) if len(sample) else (0, 1)
            count, edge = np.histogram(sample[:, j], bins=256, range=at)
            mass = np.cumsum(np.cbrt(count))
            at = np.searchsorted(mass, mass[-1] * np.arange(1, cells - 2) / (cells - 2))
            cut = np.ceil(edge[np.minimum([-1, *at, 255], 255) + 1]) - 1        # the last whole number before the edge
            self.marks.append(np.unique(cut[(cut >= least[j]) & (cut < most[j])]))
        edges = [np.concatenate(([least[j] - 1], m, [most[j]])) for j, m in enumerate(self.marks)]
        width = max(map(len, edges), default=2) - 1
        self.low = np.zeros((len(edges), width))
        self.high = np.zeros((len(edges), width))
        for j, e in enumerate(edges):
            self.low[j, :len(e) - 1], self.high[j, :len(e) - 1] = e[:-1] + 1, e[1:]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Cell numbers, two to a byte."""
        c = np.zeros((len(x), x.shape[1] + x.shape[1] % 2), np.uint8)
        for j, m in enumerate(self.marks):
            c[:, j] = np.searchsorted(m, x[:, j], side="left")
        return c[:, ::2] << 4 | c[:, 1::2]

    def numbers(self, code: np.ndarray) -> np.ndarray:
        c = np.empty((len(code), 2 * code.shape[1]), np.uint8)
        c[:, ::2], c[:, 1::2] = code >> 4, code & 15
        return c[:, :len(self.marks)]


class Shard:
    """One shard of the file in memory: ids, cells as twice their middle and
    their width, and exact vectors, decoded only where they are read."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, code: np.ndarray, exact: np.ndarray, cells: Cells):
        self.ids, self.copies, self.exact = ids, copies, exact
        number, at = cells.numbers(code), np.arange(len(cells.marks))
        low, high = cells.low[at, number], cells.high[at, number]
        self.top = float(max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)))
        self.middle, self.width = low + high, high - low
        self.single = None
        self.read = self.asked = 0

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of ``q`` with every row; sums in
        single precision where they are exact, else widened by what doubles may lose."""
        most = 2 * self.top * float(np.abs(q).max(initial=0)) * q.shape[1]
        if 2 * most < 2 ** 24:
            if self.single is None:
                self.single = self.middle.astype(np.float32).T.copy(), self.width.astype(np.float32).T.copy()
            middle, width = self.single
            q = q.astype(np.float32)
        else:
            middle, width = self.middle.T, self.width.T
        mid, span = q @ middle, np.abs(q) @ width
        slack = 0.0 if 2 * most < V.HELD else most * 1e-12
        return (mid - span) / 2 - slack, (mid + span) / 2 + slack

    def nearest(self, own: int, q: np.ndarray, lower: np.ndarray, upper: np.ndarray, known: float, k: int) \
            -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the k best of one query that may be among its k
        best of all; ``known``: a score that k rows reach."""
        rows = np.flatnonzero(upper >= known)
        rows = rows[self.ids[rows] != own]
        if len(rows) > k:
            known = max(known, np.partition(lower[rows], len(rows) - k)[len(rows) - k])
            rows = rows[upper[rows] >= known]
        rows = rows[np.argsort(-upper[rows], kind="stable")]
        found, score = rows[:0], np.zeros(0, np.int64)
        self.asked += 1
        for a in range(0, len(rows), READ):
            if len(found) == k and score[-1] > upper[rows[a]]:
                break                                   # no later row can reach the k-th
            more = rows[a:a + READ]
            self.read += len(more)
            found = np.concatenate((found, more))
            score = np.concatenate((score, V.dots(self.exact[more], q)[:, 0]))
            best = np.lexsort((self.ids[found], -score))[:k]
            found, score = found[best], score[best]
        return found, score


def _edges(rows: DataFrame, shape: V.Shape) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each component over all rows."""
    kind, dim = shape.kind, shape.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dim, np.inf), np.full(dim, -np.inf)
        for b in batches:
            if b.num_rows:
                x = V.unpacked(b.column("ints"), kind, dim)
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(low), pa.array(high)], ["j", "low", "high"])

    got = rows.select("ints").mapInArrow(run, "j int, low double, high double").groupBy("j") \
        .agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("j").toPandas()
    return got["low"].to_numpy(), got["high"].to_numpy()


def _with_cells(rows: DataFrame, shape: V.Shape, cells: Cells, shards: int) -> DataFrame:
    """The file: vec_id, copies, exact bytes, cells, shard."""
    kind, dim = shape.kind, shape.dim
    learned = rows.sparkSession.sparkContext.broadcast(cells)       # CELLS edges a component

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = V.unpacked(b.column("ints"), kind, dim)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("copies"), b.column("ints"), V.binary(learned.value.of(x))],
                                                 ["vec_id", "copies", "ints", "cells"])

    return rows.mapInArrow(run, "vec_id long, copies long, ints binary, cells binary") \
        .withColumn("shard", V.shard_of(shards, "vec_id", "ints"))


def _known(queries: DataFrame, shape: V.Shape, ids: np.ndarray, exact: np.ndarray, k: int) -> DataFrame:
    """Queries with ``known``: the k-th best score among the sample's rows."""
    kind, dim = shape.kind, shape.dim
    learned = queries.sparkSession.sparkContext.broadcast((ids, exact))     # about SAMPLE_ROWS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample_ids, sample = learned.value
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                own = part.column("vec_id").to_numpy()
                score = V.dots(V.unpacked(part.column("ints"), kind, dim), sample).astype(np.float64)
                score[own[:, None] == sample_ids[None, :]] = -np.inf
                known = np.partition(score, -k, axis=1)[:, -k] if len(sample_ids) >= k else np.full(len(own), -np.inf)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("ints"), pa.array(known)], ["vec_id", "ints", "known"])

    return queries.mapInArrow(run, "vec_id long, ints binary, known double")


def sample_of(rows: DataFrame, n: int, size: int = SAMPLE_ROWS) -> pa.Table:
    """About ``size`` of ``n`` distinct rows, by a hash of their content."""
    share = F.lit(min(1.0, size / max(1, n)))
    return rows.where(share_of(F.xxhash64("vec_id", "ints"), share)).toArrow()


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score of the k rows of largest integer inner
    product with each query."""
    spark = vectors.sparkSession
    rows = V.finite(vectors).where(F.col("vec_id").isNotNull())
    shape = V.shape_of(rows, scale)
    if not shape.rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = stored(V.collapsed(V.packed(rows, shape, scale)), "whole-vectors")
    n = rows.count()
    sample = sample_of(rows.select("vec_id", "ints"), n)
    ids, exact = sample.column("vec_id").to_numpy(), V.unpacked(sample.column("ints"), shape.kind, shape.dim)
    shards = blocks_for(n, SHARD_ROWS, LEAST_SHARDS)
    cells = Cells(exact, *_edges(rows, shape))
    file = stored(_with_cells(rows, shape, cells, shards), "va-file")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    queries = _known(asked, shape, ids, exact, k)
    learned = spark.sparkContext.broadcast(cells)
    kind, dim = shape.kind, shape.dim

    def load(t: pa.Table) -> Shard:
        code = V.unpacked(t.column("cells"), "u1", (dim + 1) // 2)
        return Shard(t.column("vec_id").to_numpy(), t.column("copies").to_numpy(), code, V.unpacked(t.column("ints"), kind, dim), learned.value)

    def answer(shard: Shard, t: pa.Table) -> Iterator[pa.Table]:
        q = V.unpacked(t.column("ints"), kind, dim).astype(np.float64)
        own, known = t.column("vec_id").to_numpy(), t.column("known").to_numpy()
        lower, upper = shard.bounds(q)
        for i in range(len(q)):
            found, score = shard.nearest(own[i], q[i:i + 1], lower[i], upper[i], known[i], k)
            if len(found):
                yield pa.table({"query_id": np.full(len(found), own[i]), "vec_id": shard.ids[found], "copies": shard.copies[found], "score": score})

    left = file.select("shard", "vec_id", "copies", "ints", "cells", F.lit(None).cast("double").alias("known"))
    right = queries.select("vec_id", F.lit(1).cast("long").alias("copies"), "ints", F.lit(None).cast("binary").alias("cells"), "known")
    found = V.meet(left, right, shards, load, answer, SCHEMA, QUERY_BLOCK)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op11_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
