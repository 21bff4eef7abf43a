"""Vector code compression: product codes, entries found through a GNAT.

A vector's whole components are cut into ``PARTS`` equal consecutive parts, and a
part is replaced by the number of the nearest entry of its codebook. Codebooks
start as the parts of the first rows by vec_id and are moved ``ROUNDS`` times to
the floored means of what was assigned to them.

The entries of a codebook stand in a geometric near-neighbour access tree: a
node has a few split points, far from each other; every other entry belongs to
the child of its nearest split point, and the node stores for each split point
and child the least and the largest distance from the point to the child's
entries. A query's distances to the split points bound its distance to every
child: if d(query, split) - largest or least - d(query, split) exceeds the best
distance so far, the whole child is left out. Only strictly farther children are
left out (the test is widened by more than its doubles can lose), and winners
are decided by whole squared distances, ties to the lower entry, so the tree
gives what a full search gives.

Each pass is one map over the stored rows with broadcast codebooks (PARTS x
ENTRIES entries, whatever the input). Sums and counts are added up in each task
and then by one grouped sum with a row for each component of each entry.

Defined results
  null vector, null or non-finite component, or a number of components other
  than the table's most frequent one
                       the row is dropped
  components not a multiple of ``PARTS``
                       zeros are added at the end
  null vec_id          kept, after all others where the first rows are chosen
  tied distances       the lower entry
  repeated vec_id      each row counts; equal ids are ordered by their bytes
  fewer rows than ``ENTRIES``
                       so many entries
  empty table          no rows
  extra columns        ignored
  components over 2 ** 53 after scaling are held to it, errors to a long
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import vectors as V
from ledgerloom.llm.common import stored, table

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
DEGREE = 6                  # split points of a node
LEAF = 6                    # entries that are compared one by one
WIDER = 1e-9                # of the distances compared: more than doubles lose
LABELS_SENT = 100_000       # a table of label sums up to so many rows is broadcast


def squares(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` from the point ``p``: as
    doubles where they hold them, else as whole numbers of any size."""
    top = float(np.abs(x).max(initial=0)) + float(np.abs(p).max(initial=0))
    if top * top * max(1, x.shape[1]) < V.HELD:
        off = x - p
        return np.einsum("ij,ij->i", off, off)
    big = np.vectorize(int, otypes=[object])
    off = big(x) - big(p)
    return (off * off).sum(axis=1)


def _distance(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


class Node:
    """Entries ``splits`` with their children and distance ranges, or a leaf's
    ``entries``."""

    def __init__(self, points: np.ndarray, entries: np.ndarray):
        self.entries, self.splits, self.children = entries, [], []
        if len(entries) <= LEAF:
            return
        self.splits = [int(entries[0])]
        away = squares(points[entries], points[entries[0]])
        away[0] = -1
        to = [squares(points[entries], points[entries[0]])]
        while len(self.splits) < DEGREE and away.max() > 0:
            far = int(np.argmax(away))
            self.splits.append(int(entries[far]))
            to.append(squares(points[entries], points[entries[far]]))
            away = np.minimum(away, to[-1])
            away[np.isin(entries, self.splits)] = -1
        square = np.stack(to)                                   # split x entry
        rest = ~np.isin(entries, self.splits)
        nearest = np.argmin(square, axis=0)
        s = len(self.splits)
        self.low, self.high = np.full((s, s), np.inf), np.full((s, s), -np.inf)
        for j in range(s):
            member = rest & (nearest == j)
            self.children.append(Node(points, entries[member]) if member.any() else None)
            if member.any():
                d = _distance(square[:, member])
                self.low[:, j], self.high[:, j] = d.min(axis=1), d.max(axis=1)


class Gnat:
    """Nearest entries of one codebook (whole numbers as doubles)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.root = Node(points, np.arange(len(points)))
        self.compared = self.asked = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``x`` its nearest entry and their squared distance."""
        kind = squares(x[:1], self.points[0]).dtype if len(x) else np.float64
        if kind != object and len(x):
            top = float(np.abs(x).max()) + float(np.abs(self.points).max(initial=0))
            kind = object if top * top * x.shape[1] >= V.HELD else kind
        self.x, self.best = x, np.full(len(x), -1, np.int64)
        self.square = np.full(len(x), np.inf, dtype=kind)
        self.asked += len(x)
        self._visit(self.root, np.arange(len(x)))
        return self.best, self.square

    def _compare(self, entry: int, rows: np.ndarray) -> np.ndarray:
        got = squares(self.x[rows], self.points[entry])
        self.compared += len(rows)
        now, best = self.square[rows], self.best[rows]
        won = ((got < now) | ((got == now) & (entry < best))).astype(bool)
        self.square[rows[won]], self.best[rows[won]] = got[won], entry
        return got

    def _visit(self, node: Node, rows: np.ndarray) -> None:
        if not node.splits:
            for e in node.entries.tolist():
                self._compare(e, rows)
            return
        d = np.stack([_distance(self._compare(e, rows)) for e in node.splits])     # split x row
        own = np.argmin(d, axis=0)
        for first in (True, False):         # the nearest split point's child first: it brings the best distance down
            for j, child in enumerate(node.children):
                if child is not None:
                    at = np.flatnonzero((own == j) == first)
                    at = at[self._may_hold(node, j, d[:, at], _distance(self.square[rows[at]]))]
                    if len(at):
                        self._visit(child, rows[at])

    @staticmethod
    def _may_hold(node: Node, j: int, d: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether child ``j`` may hold an entry as near as ``best``."""
        low, high = node.low[:, j][:, None], node.high[:, j][:, None]
        slack = WIDER * (1 + d + best + high)
        return ((d - best <= high + slack) & (d + best >= low - slack)).all(axis=0)


class Codebooks:
    """One tree a part. ``entries``: part x entry x position, whole numbers."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        self.trees = [Gnat(np.array(part, np.float64)) for part in entries]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (row x part) and squared distances summed over parts."""
        width = x.shape[1] // PARTS
        found = [t.nearest(x[:, p * width:(p + 1) * width]) for p, t in enumerate(self.trees)]
        error = sum(s.astype(object) if s.dtype == object else s.astype(np.int64) for _, s in found)
        return np.stack([b for b, _ in found], axis=1).astype(np.uint8), np.minimum(error, V.LONG).astype(np.int64)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(v) for part in self.entries for entry in part for v in entry).encode()).hexdigest()


def _parts(ints: pa.Array, kind: str, dim: int) -> np.ndarray:
    """Whole components as doubles, with zeros up to a multiple of PARTS."""
    x = V.unpacked(ints, kind, dim).astype(np.float64)
    return np.pad(x, ((0, 0), (0, -dim % PARTS)))


def first_entries(rows: DataFrame, shape: V.Shape) -> Codebooks:
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(ENTRIES).select("ints").toArrow()
    x = _parts(first.column("ints"), shape.kind, shape.dim)
    width = x.shape[1] // PARTS
    return Codebooks([[[int(v) for v in r[p * width:(p + 1) * width]] for r in x] for p in range(PARTS)])


def moved(rows: DataFrame, shape: V.Shape, books: Codebooks) -> Codebooks:
    """Each entry at the floored mean of the parts nearest to it."""
    learned = rows.sparkSession.sparkContext.broadcast(books)
    kind, dim = shape.kind, shape.dim
    n_entries, width = len(books.entries[0]), -(-dim // PARTS)
    slots = PARTS * n_entries * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(slots, object), np.zeros(slots, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _parts(b.column("ints"), kind, dim)
            code, _ = learned.value.encode(x)
            entry = np.arange(PARTS) * n_entries + code
            at = (np.repeat(entry, width, axis=1) * width + np.tile(np.arange(width), PARTS)).ravel()
            exact = float(np.abs(x).max(initial=0)) * len(x) < V.HELD
            value = x.ravel() if exact else np.vectorize(int, otypes=[object])(x).ravel()
            now = np.zeros(slots, value.dtype)
            np.add.at(now, at, value)
            total = total + (now.astype(np.int64).astype(object) if exact else now)
            count += np.bincount(at, minlength=slots)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]),
                                          pa.array([Decimal(int(total[i])) for i in used], pa.decimal128(38, 0))], ["slot", "n", "total"])

    got = rows.select("ints").mapInArrow(run, "slot int, n long, total decimal(38,0)").groupBy("slot") \
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()        # a row for each component of each entry
    entries = [[list(e) for e in part] for part in books.entries]
    for r in got:
        e, j = divmod(r["slot"], width)
        entries[e // n_entries][e % n_entries][j] = int(r["total"]) // r["n"]
    return Codebooks(entries)


def compress(vectors: DataFrame, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of rows (vec_id,
    embedding, label)."""
    spark = vectors.sparkSession
    rows = V.finite(vectors, "label")
    shape = V.shape_of(rows, scale)
    if not shape.rows:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    rows = stored(V.packed(rows, shape, scale), "whole-vectors")
    books = first_entries(rows, shape)
    for _ in range(rounds):
        books = moved(rows, shape, books)
    learned, kind, dim = spark.sparkContext.broadcast(books), shape.kind, shape.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                code, error = learned.value.encode(_parts(b.column("ints"), kind, dim))
                names = pa.array([c.tobytes().hex() for c in code])
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), names, pa.array(error)], ["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    codes = stored(rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long"), "codes")
    held = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(V.LONG)).cast("long")
    sums = codes.groupBy(F.col("label").alias("of")).agg(held.alias("label_error"))
    if sums.limit(LABELS_SENT + 1).count() <= LABELS_SENT:
        sums = F.broadcast(sums)            # else a sort-merge join, whose large partitions AQE splits
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left") \
        .select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op12_gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Rows of single components; each round assigns by full search."""
    steps = ["""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """comp AS (
  SELECT rn, (i - 1) // (len(e) // 16) AS part, (i - 1) % (len(e) // 16) AS pos, e[i] AS x
  FROM (SELECT rn, e, unnest(range(1, len(e) + 1)) AS i FROM kept))""",
             "book0 AS (SELECT part, rn - 1 AS entry, pos, x FROM comp WHERE rn <= 64)"]
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT c.rn, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS d FROM comp c JOIN book{r} b USING (part, pos) GROUP BY c.rn, c.part, b.entry
  QUALIFY row_number() OVER (PARTITION BY c.rn, c.part ORDER BY sum((c.x - b.x) * (c.x - b.x)), b.entry) = 1)""")
        if r < ROUNDS:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
    SELECT n.part, n.entry, c.pos, floor(sum(c.x) / count(*)) AS x FROM near{r} n JOIN comp c USING (rn, part) GROUP BY n.part, n.entry, c.pos) m
  USING (part, entry, pos))""")
    steps.append(f"""coded AS (
  SELECT rn, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY rn)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (rn)"""


SQL = _sql()
