"""Hard-negative mining with segment summaries.

A vector is cut into segments, and of each segment only the mean and the
deviation are kept. A segment of w components then adds to an inner product
w * (mean * mean' + d) with d between -deviation * deviation' and
+deviation * deviation', so the summaries of two vectors bound their score from
both sides. Segments are refined in steps (``LEVELS`` components a segment, the
widest first): a step bounds only rows that some anchor of the block still
needs, and only what the finest step leaves is scored exactly, in the order of
upper bounds, until no later row can be among the results.

Two searches over the same shards, each exact:
  positives  of an anchor: its ``positives`` best other rows of its label;
  negatives  of an anchor and a positive: the ``negatives`` best rows of another
             label whose score is between ``low`` and ``high`` per cent of the
             positive's. A row is left out as soon as its bounds miss all of the
             anchor's ranges, or fall under scores that enough rows of a range
             are known to reach.
Scores are whole numbers, bounds are doubles widened by more than they can
lose in rounding, so equal scores are never cut off.

Defined results
  null label, null vector, null or non-finite component, null vec_id, or a
  number of components other than the table's most frequent one
                       takes no part
  tied scores          the smaller id first
  repeated vec_id      rows of the anchor's own vec_id are neither positives nor
                       negatives; equal rows count once for each row; of an
                       anchor id with several rows the one of smallest (label,
                       bytes) asks
  positive score <= 0  the range is empty, except that 0 takes negatives of 0
  no other row of the label, or none in a range
                       no rows
  empty table          no rows
  extra columns        ignored
  components over 2 ** 53 after scaling are held to it, scores to a long
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import vectors as V
from ledgerloom.llm.common import blocks_for, share_of, stored, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
LEVELS = (16, 4, 2)         # components a segment
SAMPLE_ROWS = 4096          # first thresholds of the positives come from about so many rows
SHARD_ROWS = 1 << 16
LEAST_SHARDS = 12
BLOCK = 32
READ = 64                   # rows scored exactly in the first turn
EMPTY = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def summary(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each segment sqrt(w) * mean and sqrt(w) * deviation, whose products
    are the segment's share of an inner product."""
    edges = np.arange(0, x.shape[1], width)
    w = np.diff(np.append(edges, x.shape[1]))
    mean = np.add.reduceat(x, edges, axis=1) / w
    off = x - np.repeat(mean, w, axis=1)
    return mean * np.sqrt(w), np.sqrt(np.add.reduceat(off * off, edges, axis=1))


class Segments:
    """A shard's rows in the order of labels, with their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, exact: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.copies, self.exact = ids[order], labels[order], copies[order], exact[order]
        x = self.exact.astype(np.float64)
        self.levels = [summary(x, w) for w in LEVELS if w < x.shape[1] or w == LEVELS[-1]]
        self.norm = np.sqrt(np.einsum("ij,ij->i", x, x))
        self.bounded, self.scored, self.asked = [0] * len(self.levels), 0, 0

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def refine(self, q: np.ndarray, own: np.ndarray, rows: np.ndarray,
               needed: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows that may be results, and their upper bounds,
        the largest first. ``needed(query, lower, upper)`` tells the rows that
        bounds don't rule out."""
        norm = np.sqrt(np.einsum("ij,ij->i", q, q))
        alive = self.ids[rows][None, :] != own[:, None]
        lower = np.full(alive.shape, -np.inf)
        upper = np.full(alive.shape, np.inf)
        self.asked += alive.size
        for step, (mean, deviation) in enumerate(self.levels):
            at = np.flatnonzero(alive.any(axis=0))
            if not len(at):
                break
            self.bounded[step] += len(q) * len(at)
            width = LEVELS[-len(self.levels):][step]
            q_mean, q_deviation = summary(q, width)
            mid, span = q_mean @ mean[rows[at]].T, q_deviation @ deviation[rows[at]].T
            span += 1e-6 * (1 + norm[:, None] * self.norm[rows[at]][None, :])
            lower[:, at], upper[:, at] = np.maximum(lower[:, at], mid - span), np.minimum(upper[:, at], mid + span)
            for i in range(len(q)):
                left = np.flatnonzero(alive[i])
                alive[i, left[~needed(i, lower[i, left], upper[i, left])]] = False
        for i in range(len(q)):
            left = np.flatnonzero(alive[i])
            left = left[np.argsort(-upper[i, left], kind="stable")]
            yield rows[left], upper[i, left]

    def score(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        self.scored += len(rows)
        return V.dots(self.exact[rows], q[None, :])[:, 0]

    def positives(self, q: np.ndarray, own: np.ndarray, label: int, known: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores of each query's k best rows of ``label`` in this shard
        that may be among the k best of all; ``known``: a score that k rows reach."""
        def needed(i: int, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            return upper >= max(known[i], _kth(lower, k))

        a, z = self.of_label(label)
        for i, (rows, upper) in enumerate(self.refine(q, own, np.arange(a, z), needed)):
            found, score = rows[:0], np.zeros(0, np.int64)
            for at, z in _turns(len(rows)):
                if len(found) == k and score[-1] > upper[at]:
                    break
                more = rows[at:z]
                found, score = np.concatenate((found, more)), np.concatenate((score, self.score(more, q[i])))
                best = np.lexsort((self.ids[found], -score))[:k]
                found, score = found[best], score[best]
            yield found, score

    def negatives(self, q: np.ndarray, own: np.ndarray, label: int, ranges: list[np.ndarray], k: int) \
            -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
        """For each query and each of its ranges (least, most) the rows and
        scores of the k best rows of another label."""
        def needed(i: int, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            keep = np.zeros(len(lower), bool)
            for least, most in ranges[i]:
                if least <= most:
                    inside = lower[(lower >= least) & (upper <= most)]
                    keep |= (upper >= max(least, _kth(inside, k))) & (lower <= most)
            return keep

        a, z = self.of_label(label)
        others = np.concatenate((np.arange(a), np.arange(z, len(self.ids))))
        for i, (rows, upper) in enumerate(self.refine(q, own, others, needed)):
            best = [(rows[:0], np.zeros(0, np.int64)) for _ in ranges[i]]
            for at, z in _turns(len(rows)):
                if all(upper[at] < (s[-1] if len(s) == k else least) for (_, s), (least, most) in zip(best, ranges[i]) if least <= most):
                    break                               # no later row reaches any range's results
                more = rows[at:z]
                score = self.score(more, q[i])
                for r, (least, most) in enumerate(ranges[i]):
                    fits = (score >= least) & (score <= most)
                    if fits.any():
                        found, s = np.concatenate((best[r][0], more[fits])), np.concatenate((best[r][1], score[fits]))
                        first = np.lexsort((self.ids[found], -s))[:k]
                        best[r] = found[first], s[first]
            yield best


def _turns(n: int) -> Iterator[tuple[int, int]]:
    """Rows to score in one turn: each turn twice the one before."""
    at, size = 0, READ
    while at < n:
        yield at, min(n, at + size)
        at, size = at + size, 2 * size


def _kth(x: np.ndarray, k: int) -> float:
    return np.partition(x, len(x) - k)[len(x) - k] if len(x) >= k else -np.inf


def score_range(positive: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and most whole score s with low * positive <= 100 * s <= high * positive."""
    return -((-low * positive) // 100), (high * positive) // 100


def _known(anchors: DataFrame, shape: V.Shape, sample: pa.Table, k: int) -> DataFrame:
    """Anchors with ``known``: the k-th best score among the sample's rows of
    their label."""
    kind, dim = shape.kind, shape.dim
    own_sample = (sample.column("vec_id").to_numpy(), sample.column("label").to_numpy(), V.unpacked(sample.column("ints"), kind, dim))
    learned = anchors.sparkSession.sparkContext.broadcast(own_sample)       # about SAMPLE_ROWS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, x = learned.value
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                score = V.dots(V.unpacked(part.column("ints"), kind, dim), x).astype(np.float64)
                no = (part.column("vec_id").to_numpy()[:, None] == ids) | (part.column("label").to_numpy()[:, None] != labels)
                score[no] = -np.inf
                known = np.partition(score, -k, axis=1)[:, -k] if len(ids) >= k else np.full(len(score), -np.inf)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("vec_id", "label", "ints")), pa.array(known)],
                                                 ["vec_id", "label", "ints", "known"])

    return anchors.mapInArrow(run, "vec_id long, label long, ints binary, known double")


def _each_copy(found: DataFrame, k: int) -> DataFrame:
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    from rows (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = V.finite(vectors, F.col("label").cast("long").alias("label")).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    shape = V.shape_of(rows, scale)
    if not shape.rows:
        return spark.createDataFrame([], EMPTY)
    rows = stored(V.collapsed(V.packed(rows, shape, scale)), "labelled-vectors")
    n = rows.count()
    shards = blocks_for(n, SHARD_ROWS, LEAST_SHARDS)
    share = F.lit(min(1.0, SAMPLE_ROWS / n))
    sample = rows.where(share_of(F.xxhash64("vec_id", "label", "ints"), share)).select("vec_id", "label", "ints").toArrow()
    kind, dim = shape.kind, shape.dim

    def load(t: pa.Table) -> Segments:
        return Segments(*(t.column(c).to_numpy() for c in ("vec_id", "label", "copies")), V.unpacked(t.column("ints"), kind, dim))

    def by_label(t: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Table]]:
        labels = t.column("label").to_numpy()
        for label in np.unique(labels):
            part = t.take(pa.array(np.flatnonzero(labels == label)))
            yield int(label), V.unpacked(part.column("ints"), kind, dim).astype(np.float64), part.column("vec_id").to_numpy(), part

    def find_positives(shard: Segments, t: pa.Table) -> Iterator[pa.Table]:
        for label, q, own, part in by_label(t):
            for i, (found, score) in enumerate(shard.positives(q, own, label, part.column("known").to_numpy(), positives)):
                if len(found):
                    yield pa.table({"anchor_id": np.full(len(found), own[i]), "positive_id": shard.ids[found],
                                    "copies": shard.copies[found], "positive_score": score})

    def find_negatives(shard: Segments, t: pa.Table) -> Iterator[pa.Table]:
        for label, q, own, part in by_label(t):
            wanted = [[(x["positive_id"], x["positive_score"]) for x in p] for p in part.column("found").to_pylist()]
            ranges = [np.array([score_range(s, low, high) for _, s in p]) for p in wanted]
            for i, best in enumerate(shard.negatives(q, own, label, ranges, negatives)):
                for slot, (found, score) in enumerate(best):
                    if len(found):
                        m = len(found)
                        yield pa.table({"anchor_id": np.full(m, own[i]), "slot": np.full(m, slot, np.int32),
                                        "positive_id": np.full(m, wanted[i][slot][0]), "positive_score": np.full(m, wanted[i][slot][1]),
                                        "negative_id": shard.ids[found], "copies": shard.copies[found], "negative_score": score})

    dealt = rows.withColumn("shard", V.shard_of(shards, "vec_id", "label", "ints")).select("shard", "vec_id", "label", "copies", "ints")
    chosen = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "ints")).alias("row")) \
        .select("vec_id", "row.label", "row.ints")
    anchors = _known(chosen, shape, sample, positives)
    one = F.lit(1).cast("long").alias("copies")
    found = V.meet(dealt.withColumn("known", F.lit(None).cast("double")), anchors.select("vec_id", "label", one, "ints", "known"), shards,
                   load, find_positives, "anchor_id long, positive_id long, copies long, positive_score long", BLOCK, ("label",))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    pairs = _each_copy(found, positives).withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    lists = pairs.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("found"))
    asked = stored(chosen.join(lists, chosen["vec_id"] == lists["anchor_id"])       # both have a row an anchor
                   .select("vec_id", "label", one, "ints", "found"), "positives")
    nothing = F.lit(None).cast(asked.schema["found"].dataType)
    hard = V.meet(dealt.withColumn("found", nothing), asked, shards, load, find_negatives,
                  "anchor_id long, slot int, positive_id long, positive_score long, negative_id long, copies long, negative_score long", BLOCK, ("label",))
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return _each_copy(hard, negatives).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(rows, F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 100 * n.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 3
"""
