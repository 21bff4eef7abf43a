"""Approximate nearest neighbours by multi-index hashing.

Binary codes are learned: principal directions, rotated by iterative
quantisation so that signs lose as little as possible. A code is split into
``SUBSTRINGS``; each substring of each row is indexed. For a query, pigeonhole
says that a code within Hamming radius r agrees with the query in at least one
substring up to r // SUBSTRINGS bits, so every index is probed at all its keys
that near, which retrieves every code within r; the found codes are checked
against r and reranked by the cosine of the original vectors in double
precision.

The rotation and the radius are learned on a bounded sample of at most about
``SAMPLE_ROWS`` rows; the radius is the Hamming distance that holds the share
``TARGET`` of the sample's true neighbours. Every row is indexed: rows are dealt
to shards of bounded size, queries to blocks, and a task searches one shard
for one block and returns the ``k`` best of each query. A query that finds
fewer than k in all shards is searched again with the largest radius, which
leaves out no code.

Defined results
  null vector, null or non-finite component, zero vector, null vec_id,
  or a number of components other than the table's most frequent one
                       takes no part, as query or candidate
  tied scores          the smaller vec_id first
  repeated vec_id      rows of the query's own vec_id are no candidates; a
                       repeated candidate may be returned once for each row, a
                       repeated query once
  fewer candidates     all of them
  empty table          no rows
  extra columns        ignored
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks_for, share_of, stored, table

BITS = 64
SUBSTRINGS = 4
SUB_BITS = BITS // SUBSTRINGS
SAMPLE_ROWS = 4096
SAMPLE_QUERIES = 512
TARGET = 0.985
ROTATION_STEPS = 25
SHARD_ROWS = 1 << 16
LEAST_SHARDS = 6            # of a small table, for parallel work
QUERY_BLOCK = 2048


class Codes:
    """Learned codes: mean and projections (one rotation for each ``dim`` bits)."""

    def __init__(self, x: np.ndarray, bits: int = BITS):
        dim = x.shape[1]
        self.mean = x.mean(axis=0)
        y = x - self.mean
        _, _, v = np.linalg.svd(y.T @ y)
        v = v[: min(dim, bits)].T
        z, parts, got = y @ v, [], 0
        for seed in range(bits):
            if got >= bits:
                break
            r, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((v.shape[1], v.shape[1])))
            for _ in range(ROTATION_STEPS):
                b = np.where(z @ r > 0, 1.0, -1.0)
                u, _, w = np.linalg.svd(z.T @ b)
                r = u @ w
            parts.append(v @ r)
            got += v.shape[1]
        self.project = np.concatenate(parts, axis=1)[:, :bits]

    def of(self, x: np.ndarray) -> np.ndarray:
        """64-bit codes of unit vectors."""
        bit = (x - self.mean) @ self.project > 0
        return np.packbits(bit, axis=1, bitorder="little").view("<u8")[:, 0]


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def learn(sample: np.ndarray, k: int, target: float = TARGET) -> tuple[Codes, int]:
    """Codes and the radius that holds ``target`` of the true neighbours."""
    x = unit(sample)
    codes = Codes(x)
    c = codes.of(x)
    q = np.linspace(0, len(x) - 1, min(len(x), SAMPLE_QUERIES)).astype(int)
    cos = x[q] @ x.T
    cos[np.arange(len(q)), q] = -2
    near = np.argsort(-cos, axis=1)[:, :min(k, len(x) - 1)]
    if not near.size:
        return codes, BITS
    distance = np.bitwise_count(c[q][:, None] ^ c[near])
    return codes, int(np.quantile(distance, target, method="higher"))


class MultiIndex:
    """Substring indexes of one shard's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.keys, self.starts, self.rows = [], [], []
        for s in range(SUBSTRINGS):
            sub = self.substring(codes, s)
            order = np.argsort(sub, kind="stable")
            keys, first = np.unique(sub[order], return_index=True)
            self.keys.append(keys)
            self.starts.append(np.append(first, len(codes)))
            self.rows.append(order)

    @staticmethod
    def substring(codes: np.ndarray, s: int) -> np.ndarray:
        return (codes >> np.uint64(s * SUB_BITS)).astype(np.uint64) & np.uint64((1 << SUB_BITS) - 1)

    def probe(self, s: int, key: int, radius: int, masks: list[np.ndarray]) -> np.ndarray:
        """Places in ``keys`` of the keys within ``radius`` of ``key``: by
        trying every such key, or by looking at every key there is, whichever
        is fewer."""
        keys = self.keys[s]
        tries = masks[radius]
        if len(tries) < len(keys):
            want = tries ^ np.uint64(key)
            at = np.searchsorted(keys, want)
            at[at == len(keys)] = 0
            return at[keys[at] == want]
        return np.flatnonzero(np.bitwise_count(keys ^ np.uint64(key)) <= radius)

    def within(self, code: np.uint64, radius: int, masks: list[np.ndarray]) -> np.ndarray:
        """Rows whose code is within ``radius`` of ``code``, ascending."""
        seen = np.zeros(len(self.codes), bool)
        for s in range(SUBSTRINGS):
            key = int(self.substring(np.array([code]), s)[0])
            at = self.probe(s, key, min(SUB_BITS, radius // SUBSTRINGS), masks)
            first, n = self.starts[s][at], np.diff(self.starts[s])[at]
            ends = np.cumsum(n)
            if len(ends):
                seen[self.rows[s][np.arange(ends[-1]) + np.repeat(first - (ends - n), n)]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]


def probe_masks(radius: int, most: int) -> list[np.ndarray]:
    """For each radius up to ``radius``, all differences of so many bits or
    fewer; not listed beyond ``most``, where looking at every key is cheaper."""
    out, now = [], [0]
    for r in range(radius + 1):
        if r and now is not None:
            now = now + [sum(1 << b for b in c) for c in combinations(range(SUB_BITS), r)]
        if now is not None and len(now) > most:
            now = None
        out.append(np.array(now, np.uint64) if now is not None else np.zeros(most + 1, np.uint64))
    return out


def search_block(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, codes: Codes,
                 radius: int, k: int) -> list[tuple[int, int, float]]:
    """(query, row, cosine) of the k best rows found for each query."""
    order = np.argsort(ids, kind="stable")
    ids, x, q = ids[order], unit(rows[order]), unit(queries)
    index = MultiIndex(codes.of(x))
    masks = probe_masks(min(SUB_BITS, radius // SUBSTRINGS), max(len(a) for a in index.keys))
    out = []
    for own, vector, code in zip(q_ids, q, codes.of(q)):
        found = index.within(code, radius, masks)
        found = found[ids[found] != own]
        cos = np.einsum("ij,j->i", x[found], vector)       # row by row: equal vectors get equal scores
        best = np.argsort(-cos, kind="stable")[:k]
        out += zip([int(own)] * len(best), ids[found[best]].tolist(), cos[best].tolist())
    return out


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id (long) and embedding of the rows that take part."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & e.isNotNull()).where(fine & F.exists(e, lambda x: x != 0)) \
        .select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    most = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (most["n"] if most else 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _search(rows: DataFrame, queries: DataFrame, n_rows: int, n_queries: int, codes: Codes, radius: int, k: int) -> DataFrame:
    spark = rows.sparkSession
    shards = blocks_for(n_rows, SHARD_ROWS, LEAST_SHARDS)
    blocks = blocks_for(n_queries, QUERY_BLOCK)
    learned = spark.sparkContext.broadcast(codes)       # a matrix of dim x BITS

    def run(t: pa.Table) -> pa.Table:
        is_query = t.column("is_query").to_numpy(zero_copy_only=False)
        ids, x = t.column("vec_id").to_numpy(), _matrix(t.column("embedding"))
        found = search_block(ids[is_query], x[is_query], ids[~is_query], x[~is_query], learned.value, radius, k) \
            if is_query.any() and not is_query.all() else []
        q, v, s = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    # each shard of rows meets each block of queries once
    left = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"),
                       F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
                       F.lit(False).alias("is_query"), "vec_id", "embedding")
    right = queries.select(F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"),
                           F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).alias("block"),
                           F.lit(True).alias("is_query"), "vec_id", "embedding")
    return left.unionByName(right).groupBy("shard", "block") \
        .applyInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each query."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    queries = rows.where(is_query).dropDuplicates(["vec_id"])
    n_rows, n_queries = rows.count(), queries.count()
    sample = rows.where(share_of(F.col("vec_id"), F.lit(min(1.0, SAMPLE_ROWS / max(1, n_rows))))) \
        .select("vec_id", "embedding").toArrow()
    if not n_queries or sample.num_rows < 2:
        sample = rows.limit(SAMPLE_ROWS).select("vec_id", "embedding").toArrow()
    if not n_queries or not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = sample.sort_by("vec_id")
    codes, radius = learn(_matrix(sample.column("embedding")), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
            .select("query_id", "rank", "vec_id", "score")

    first = stored(best(_search(rows, queries, n_rows, n_queries, codes, radius, k)), "neighbours")
    whole = first.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") == k)
    short = queries.join(whole, queries["vec_id"] == whole["query_id"], "left_anti")
    n_short = short.count()
    if not n_short:
        return first
    again = best(_search(rows, short, n_rows, n_short, codes, BITS, k))
    return first.join(whole.select("query_id"), "query_id", "left_semi") \
        .select("query_id", "rank", "vec_id", "score").unionByName(again)


def op2_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
