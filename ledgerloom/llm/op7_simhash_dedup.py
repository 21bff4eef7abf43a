"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has 64 bits, the majority vote of the XXH64 (seed 42) of the
text's word shingles, repeats included. Two fingerprints link at ``RADIUS`` or
fewer differing bits; linked documents form components.

Equal fingerprints are one row from the start. Distinct fingerprints are laid
out in blocks of bounded size, ordered by population count; a pair of blocks
is compared only if their population counts can be within the radius. Inside a
pair of blocks, tiles of rows with the same population counts in 1, 2, 4 or 8
sub-words are compared with numpy exclusive-or and bit counts, and a pair of
tiles is skipped if its counts differ by more than the radius in sum (each
differing bit changes one of them by one, so nothing is missed). A pair of
blocks returns a spanning star of what it links, never all pairs.

Defined results
  null, empty or wordless text   fingerprint 0, linked like any other
  fewer words than a shingle     one shingle, the whole sequence
  very long text                 hashed whole
  a bit set in exactly half      0
  ties, repeated rows            equal texts share fingerprint and component
  null doc_id                    has a component like any other; never its smallest id
  empty table                    no rows
  extra columns                  ignored by the query, kept by the stage
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import small_batches, stored, table
from ledgerloom.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCK_ROWS = 1 << 18        # most fingerprints of a block; a task holds two blocks
LEAST_BLOCKS = 24           # blocks of a small input, for parallel work
TILE = (64, 2048)           # rows and columns compared at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII white space, A-Z only
    if not words:
        return 0
    whole = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))      # one past the space after each word
    starts = [0, *ends[:-1]]
    h = xxhash.xxh64_intdigest
    last = ends[shingle - 1:] or ends[-1:]
    hashes = np.array([h(whole[s:e - 1], SEED) for s, e in zip(starts, last)], np.uint64)
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[k:k + 8192].view(np.uint8), bitorder="little").reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def block_layout(counts: dict[int, int], block_rows: int, least_blocks: int) -> list[tuple[int, int, int, int]]:
    """(lowest, highest population count, first block, blocks) of each run of
    population counts, so that a block has about ``size`` rows or fewer."""
    size = max(1, min(block_rows, math.ceil(sum(counts.values()) / least_blocks)))
    runs: list[list[int]] = []
    for p in sorted(counts):
        if runs and runs[-1][2] + counts[p] <= size:
            runs[-1][1], runs[-1][2] = p, runs[-1][2] + counts[p]
        else:
            runs.append([p, p, counts[p]])
    out, first = [], 0
    for low, high, n in runs:
        k = math.ceil(n / size)
        out.append((low, high, first, k))
        first += k
    return out


class Stars:
    """Components of the rows of one pair of blocks; a row's label is the
    smallest row it is linked with."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        self.waiting.append((u, v))
        self.n_waiting += len(u)
        if self.n_waiting > 1 << 18:
            self.flush()

    def flush(self) -> None:
        if self.waiting:
            self.link(*(np.concatenate(x) for x in zip(*self.waiting)))
            self.waiting, self.n_waiting = [], 0

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        while len(u):
            a, b = self.label[u], self.label[v]
            open_ = a != b
            u, v, a, b = u[open_], v[open_], a[open_], b[open_]
            if not len(u):
                return
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def tiles(fp: np.ndarray, sub_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows by their sub-words' population counts, where each tile
    begins in that order (and the end), and the tiles' counts."""
    bits = 64 // sub_words
    own = fp[:, None] >> (np.arange(sub_words, dtype=np.uint64) * np.uint64(bits))
    if sub_words > 1:
        own &= np.uint64((1 << bits) - 1)
    counts = np.bitwise_count(own).astype(np.int16)
    order = np.lexsort(counts.T)
    counts = counts[order]
    first = np.flatnonzero(np.concatenate(([True], (counts[1:] != counts[:-1]).any(axis=1))))
    return order, np.append(first, len(fp)), counts[first]


def sub_words_for(fp: np.ndarray) -> int:
    """The finest split that leaves tiles of about 200 rows or more."""
    for k in (8, 4, 2):
        if len(fp) >= 200 * len(tiles(fp, k)[2]):
            return k
    return 1


def compare(a: np.ndarray, b: np.ndarray | None, radius: int, stars: Stars) -> None:
    """Link the rows of ``a`` with those of ``b`` (numbered after a's), or
    with each other, at ``radius`` or fewer differing bits."""
    k = min(sub_words_for(a), sub_words_for(b if b is not None else a))
    order_a, start_a, counts_a = tiles(a, k)
    order_b, start_b, counts_b = (order_a, start_a, counts_a) if b is None else tiles(b, k)
    fa, fb = a[order_a], (a if b is None else b)[order_b]
    shift = 0 if b is None else len(a)
    for i in range(len(counts_a)):
        near = np.flatnonzero(np.abs(counts_b - counts_a[i]).sum(axis=1) <= radius)
        if b is None:
            near = near[near >= i]
        if not len(near):
            continue
        cols = np.concatenate([np.arange(start_b[j], start_b[j + 1]) for j in near])
        other = fb[cols]
        for r in range(start_a[i], start_a[i + 1], TILE[0]):
            mine = fa[r:min(r + TILE[0], start_a[i + 1]), None]
            for c in range(0, len(cols), TILE[1]):
                hit = np.bitwise_count(mine ^ other[None, c:c + TILE[1]]) <= radius
                if hit.any():
                    u, v = np.nonzero(hit)
                    stars.add(order_a[r + u], order_b[cols[c + v]] + shift)


def linked(distinct: DataFrame, radius: int = RADIUS, block_rows: int = BLOCK_ROWS,
           least_blocks: int = LEAST_BLOCKS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that keep every
    component linked."""
    spark = distinct.sparkSession
    ones = F.bit_count("fp")
    counts = {r["p"]: r["n"] for r in distinct.groupBy(ones.alias("p")).agg(F.count("*").alias("n")).collect()}  # 65 rows
    layout = block_layout(counts, block_rows, least_blocks)
    if not layout:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    facts = []
    for low, high, first, k in layout:      # the blocks within the radius lie side by side
        near = [x for x in layout if x[0] <= high + radius and x[1] >= low - radius]
        facts += [(p, first, k, near[0][2], near[-1][2] + near[-1][3] - 1) for p in range(low, high + 1)]
    facts = spark.createDataFrame(facts, "p int, first int, k int, low int, high int")
    placed = distinct.select("fp").join(F.broadcast(facts), ones == F.col("p")) \
        .withColumn("block", (F.col("first") + F.pmod(F.xxhash64("fp"), F.col("k"))).cast("int"))
    sent = placed.select("fp", "block", F.explode(F.sequence("low", "high")).alias("other")) \
        .select("fp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                (F.col("block") > F.col("other")).alias("second"))

    def run(t: pa.Table) -> pa.Table:
        fp = t.column("fp").to_numpy().view(np.uint64)
        second = t.column("second").to_numpy(zero_copy_only=False)
        own = t.column("i")[0] == t.column("j")[0]
        fp, second = fp[order := np.argsort(fp)], second[order]
        rows = fp if own else np.concatenate((fp[~second], fp[second]))
        stars = Stars(len(rows))
        if own:
            compare(rows, None, radius, stars)
        elif second.any() and not second.all():
            compare(rows[: len(fp) - second.sum()], rows[len(fp) - second.sum():], radius, stars)
        stars.flush()
        moved = np.flatnonzero(stars.label != np.arange(len(rows)))
        rows = rows.view(np.int64)
        return pa.table({"a": rows[moved], "b": rows[stars.label[moved]]})

    return sent.groupBy("i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    kind = docs.schema["doc_id"].dataType
    fps = stored(fingerprints(docs, shingle), "fps")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(linked(distinct, radius))
    found = distinct.join(roots, distinct["fp"] == roots["node"], "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = found.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = found.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        F.col("component_id").cast(kind))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row stays, that with the smallest
    doc_id (null ids last), then the smallest hash of the text; a row that is
    there twice with both equal stays once."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner, key, text = docs.toDF(*names), names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    row = lambda i, t: F.struct(F.when(F.col(i).isNull(), True).alias("nil"), F.col(i).alias("id"), F.sha2(F.col(t), 256).alias("hash"))
    near = near_duplicates(docs.select(row("doc_id", "text").alias("doc_id"), "text"))
    kept = near.where("doc_id <=> component_id").select(F.col("doc_id").alias("kept__")).distinct()
    one = inner.withColumn("row__", row(key, text)).join(kept, F.col("row__").eqNullSafe(F.col("kept__")))
    return one.dropDuplicates(["row__"]).drop("row__", "kept__").toDF(*docs.columns)
